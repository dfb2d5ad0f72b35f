"""Language identification against a plain version of the same method."""

import collections
import math
import random

from oddrows.llm import language

MASK = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def cells(text):
    """Counts of hashed n-grams of letters, None without a letter."""
    low = (text or "").lower()
    if not any(c.isalpha() for c in low):
        return None
    kept = [ord(c) if c.isalpha() else 32 for i, c in enumerate(low) if c.isalpha() or i == 0 or low[i - 1].isalpha()]
    points = [32, *kept, 32]
    found = collections.Counter()
    for n in (1, 2, 3):
        for i in range(len(points) - n + 1):
            value = 0
            for p in points[i:i + n]:
                value = (value * 0x110000 + p) & MASK
            found[mixed((value + (n << 61 if n > 1 else 0)) & MASK) % language.DIMS] += 1
    return found


def unit(v):
    size = math.sqrt(sum(x * x for x in v.values()))
    return {c: x / size for c, x in v.items()} if size else v


def cosine(a, b):
    return sum(x * b.get(c, 0.0) for c, x in a.items())


def clustered(rows, k, rounds):
    mean = collections.Counter()
    for r in rows:
        for c, x in r.items():
            mean[c] += x / len(rows)
    chosen = [max(range(len(rows)), key=lambda i: cosine(rows[i], mean))]
    while len(chosen) < min(k, len(rows)):
        chosen.append(min(range(len(rows)), key=lambda i: max(cosine(rows[i], rows[j]) for j in chosen)))
    centres = [rows[i] for i in chosen]
    for _ in range(rounds):
        own = [max(range(len(centres)), key=lambda c: cosine(r, centres[c])) for r in rows]
        for c in range(len(centres)):
            total = collections.Counter()
            for r, o in zip(rows, own):
                if o == c:
                    for cell, x in r.items():
                        total[cell] += x
            if total:
                centres[c] = unit(total)
    return centres


def brute(train, texts):
    counted = [(lang, cells(t)) for _, t, lang in sorted(train, key=lambda r: str(r[0]))]
    counted = [(lang, c) for lang, c in counted if c]
    held = collections.Counter(c for _, own in counted for c in own)
    idf = lambda c: math.log((1 + len(counted)) / (1 + held[c])) + 1
    vector = lambda own: unit({c: (1 + math.log(n)) * idf(c) for c, n in own.items()})
    centres = [(lang, centre) for lang in sorted({lang for lang, _ in counted})
               for centre in clustered([vector(c) for x, c in counted if x == lang], language.CENTROIDS, language.ROUNDS)]
    out = []
    for t in texts:
        own = cells(t)
        if own is None:
            out.append((language.UNKNOWN, 0.0))
            continue
        v = vector(own)
        best = max(range(len(centres)), key=lambda i: (cosine(v, centres[i][1]), -i))
        out.append((centres[best][0], min(max(cosine(v, centres[best][1]), 0.0), 1.0)))
    return out


def test_predictions_against_brute_force(spark):
    rng = random.Random(3)
    vocabularies = {"xa": ["bano", "kelu", "mira", "tosa", "élan"], "xb": ["schrum", "tragst", "wurz", "pfend", "größe"], "xc": ["日本", "語文", "кот", "дом", "лес"]}
    made = lambda lang: rng.choice([" ", ", ", "\n1. "]).join(rng.choice(vocabularies[lang]) for _ in range(rng.randint(2, 15)))
    rows = [(k, made(lang), lang) for k, lang in enumerate(rng.choice(list(vocabularies)) for _ in range(60))]
    train = [r for r in rows if r[0] < 45]
    texts = [t for _, t, _ in rows] + [None, "", "123", "bano tragst", "-kelu", "wurz!", "zz qq", "MIRA mira " * 500]
    frame = spark.createDataFrame([(str(k), t, lang) for k, t, lang in train], "key string, text string, lang string")
    model = language.fit(frame)
    asked = spark.createDataFrame(list(enumerate(texts)), "n long, text string").repartition(3)
    got = {r["n"]: (r["lang_pred"], r["score"], r["rejected"]) for r in language.predict(asked, model).collect()}
    for n, (lang, score) in enumerate(brute(train, texts)):
        assert got[n][0] == lang and abs(got[n][1] - score) < 1e-4, (n, texts[n], got[n], lang, score)
        assert got[n][2] == (got[n][1] < language.REJECT_BELOW)
