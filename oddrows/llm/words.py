"""Words and shingles of Arrow text batches as 64-bit hashes, computed over whole byte buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0x100000001B3
_STEP_BACK = pow(_STEP, -1, 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.arange(256, dtype=np.uint8)
    low = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    sign = ~((codes >= 128) | ((low >= 97) & (low <= 122)) | ((codes >= 48) & (codes <= 57)))
    return low, space, sign


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 places where its texts begin and end; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[ends[0]: ends[-1]], ends - ends[0]


def _block_words(body: np.ndarray, cut: np.ndarray, apart: np.ndarray, low: np.ndarray, powers, back) -> tuple:
    """Hashes and start places of the words of one block; `cut` marks first bytes of texts."""
    inside = ~apart[body]
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut))
    follows = np.concatenate([inside[1:], [False]])
    stops = np.flatnonzero(inside & (~follows | np.concatenate([cut[1:], [True]]))) + 1
    letters = mixed((low[body].astype(np.uint64) + np.uint64(1)) * _ODD)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(letters * powers[: len(body)])])
    return mixed((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64)), starts


def word_hashes(column: pa.Array, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased) and the n + 1 places where each text's words begin.

    Words are runs of other than ASCII white space, or with `letters_only` runs of ASCII letters,
    digits and non-ASCII characters. Works on blocks of about a megabyte, cut between words."""
    body, ends = text_bytes(column)
    low, space, sign = _byte_tables()
    apart = sign if letters_only else space
    found, places, at = [], [], 0
    powers = back = np.ones(0, np.uint64)
    first = np.zeros(len(body) + 1, bool)
    first[ends[:-1]] = True
    while at < len(body):
        stop = min(len(body), at + BLOCK_BYTES)
        while stop < len(body):  # to the next byte that is no part of a word, or the next text
            free = np.flatnonzero(apart[body[stop: stop + BLOCK_BYTES]] | first[stop: min(stop + BLOCK_BYTES, len(body))])
            if len(free):
                stop += int(free[0])
                break
            stop = min(len(body), stop + BLOCK_BYTES)
        if len(powers) < stop - at:
            size = stop - at
            powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _STEP, np.uint64)]))
            back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, _STEP_BACK, np.uint64)]))
        hashes, starts = _block_words(body[at:stop], first[at:stop], apart, low, powers, back)
        found.append(hashes)
        places.append(starts + at)
        at = stop
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    where = np.concatenate(places) if places else np.zeros(0, np.int64)
    return hashes, np.searchsorted(where, ends)


#: non-ASCII punctuation, symbols and white space
_APART = r"[^\x00-\x7f\p{L}\p{M}\p{N}\p{C}]|[\x{80}-\x{9f}\x{200b}\x{feff}]"
#: a character, with its marks, of scripts that put no blanks between words
_UNSPACED = (r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\p{Yi}\x{30fc}\x{ff70}]\p{M}*")


def unicode_words(column: pa.Array) -> pa.Array:
    """Texts in which blanks stand for non-ASCII signs and around each character of scripts without blanks, so
    that `word_hashes` with `letters_only` finds words of all scripts."""
    import pyarrow.compute as pc

    column = column.cast(pa.large_string())
    plain = pc.fill_null(pc.string_is_ascii(column), True)
    if pc.all(plain).as_py() in (True, None):
        return column
    rest = pc.filter(column, pc.invert(plain))
    rest = pc.replace_substring_regex(rest, _APART, " ")
    rest = pc.replace_substring_regex(rest, f"({_UNSPACED})", r" \1 ")
    return pc.replace_with_mask(column, pc.invert(plain), rest)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words; runs do not know where texts end."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = mixed(total + words[k: len(words) - size + 1 + k] * np.uint64(2 * k + 3))
    return total


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; with fewer words the whole sequence is the one shingle."""
    words, at = word_hashes(column)
    runs = run_hashes(words, size)
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            yield np.unique(runs[a: b - size + 1])
        elif b > a:
            yield run_hashes(words[a:b], int(b - a)) + np.uint64(b - a)
        else:
            yield words[:0]


def slices(batch: pa.RecordBatch, name: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about `most_bytes` of text each, one row at least."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop
