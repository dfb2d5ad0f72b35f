"""Small cases of the operators that are built from DataFrame functions, and of the queries against their SQL."""

import duckdb
import pytest

from oddrows.llm import catalog, licenses, lines, quality, texts
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, text string, n_words string, kept string, _row int, carried string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, FOLDER)
    cursor = db.execute(catalog.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, df.select(*columns).toPandas().astype(object).where(lambda x: x.notna(), None).values.tolist())) == \
        sorted(repr(list(r)) for r in cursor.fetchall())


def test_ranges_are_cut_out(spark):
    df = spark.createDataFrame([(list("abcdefgh"), [0, 1, 5]), (list("abc"), []), ([], []), (list("abcd"), [1])], "x array<string>, s array<int>")
    got = [r.o for r in df.select(texts.without_ranges(F.col("x"), F.col("s"), 3).alias("o")).collect()]
    assert got == [["e"], ["a", "b", "c"], [], ["a"]]


def test_repeat_windows_by_hand(spark):
    def brute(text):
        w = text.split()
        grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        places = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
        return len(places)
    cases = ["a " * 30, "a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g h", "x " * 7, "", "  \n\t ", "a b " * 9 + "c " + "a b " * 5]
    rows = [(k, "s", t) for k, t in enumerate(cases)]
    got = {r.doc_id: r for r in quality.op4(docs_of(spark, rows)).collect()}
    assert [got[k].n_repeat_words for k in range(len(cases))] == [brute(t) for t in cases]
    assert [got[k].n_words for k in range(len(cases))] == [len(t.split()) for t in cases]


def test_quality_edges(spark):
    body = " ".join(f"w{k}" for k in range(30))
    boiler = "one two three four five six seven eight nine ten 77"
    rows = [(None, None, body), (1, "h", None), (1, "h", None), (2, "h", ""), (3, "h", "é" * 100_000)]
    rows += [(10 + k, "h", f"{body} {'xyzuvwabcdef'[k]}\n{boiler.replace('77', str(k))}") for k in range(12)]
    rows += [(40 + k, "g", f"{boiler}\n{boiler}\nlast {k}") for k in range(12)]
    out = quality.quality_rules(docs_of(spark, rows))
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert got[None].kept and not got[1].kept and got[1].n_words == 0 and not got[2].kept
    assert all(got[10 + k].kept and got[10 + k].kept_text == f"{body} {'xyzuvwabcdef'[k]}" and got[10 + k].n_line_words == 11 for k in range(12))
    assert all(not got[40 + k].kept for k in range(12))
    assert quality.op4(docs_of(spark, rows).limit(0)).count() == 0


def test_line_dedup_against_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [(k if k != 7 else None, "s", "\n".join(rng.choice(["a", " b", "c ", "", "d"]) for _ in range(rng.randint(0, 12)))) for k in range(60)]
    rows += [(100, "s", None), (101, "s", ""), (102, "s", "a\nb"), (50, "s", rows[50][2])]
    seen, want = set(), {}
    for d, _, t in sorted({r for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = [x.strip() for x in (t or "").split("\n") if x.strip()]
        gone = set()
        for i in range(len(own) - 2):
            if tuple(own[i:i + 3]) in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(tuple(own[i:i + 3]))
        want[d] = (len(own), len(gone), "\n".join(x for i, x in enumerate(own) if i not in gone) if gone else t)
    out = lines.line_dedup(docs_of(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in out} == want
    assert lines.op6(docs_of(spark, rows).limit(0)).count() == 0


def test_license_edges(spark):
    mit = dict(licenses.TEMPLATES)["MIT"]
    rows = [(1, "s", None), (2, "s", ""), (3, "s", "RELEASED  under the -- MIT license!\nfoo bar"), (3, "s", "RELEASED  under the -- MIT license!\nfoo bar"),
            (4, "s", "word " * 50_000), (None, "s", "All rights reserved.\nAll rights reserved."),
            (5, "s", "intro\n\n" + mit[:40] + "\n" + mit[40:] + "\n\noutro")]
    out = licenses.op1(docs_of(spark, rows)).collect()
    best = {}
    for r in out:
        best[r.doc_id] = max(best.get(r.doc_id, (0, "")), (r.dice, r.license))
    assert set(best) == {3, None, 5} and len({(r.doc_id, r.span) for r in out}) == len(out)
    assert best[3] == (1.0, "MIT") and best[None] == (1.0, "LicenseRef-All-Rights-Reserved") and best[5][0] > 0.9
    assert licenses.op1(docs_of(spark, rows).limit(0)).count() == 0
