"""The stages of the pipeline, each on its own input, against plain versions."""

from __future__ import annotations

import math
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from ledgerloom.llm import linedups, lines  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _gone string, cleaned int"


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    odd = [(9001, None, None, None, None), (9002, "", "en", None, 0), (None, docs[3][1], "en", "s", 5), (9003, docs[3][1], None, "s", None), (9003, docs[3][1], None, "s", None), (docs[5][0], docs[6][1], "x", "y", 1)]
    return [(*r, "g", 7) for r in docs + odd]


def stage(spark, name, rows, sf_dir):
    df = dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame(rows, SCHEMA), sf_dir)
    assert df.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_quality_rules(spark, rows, sf_dir):
    want = []
    for r, q in zip(rows, brute.quality([x[:2] for x in rows]), strict=True):
        text, _, lost = lines.clean(r[1]) if r[1] else (r[1], 0, 0)
        if not q[6] and lost <= 0.5 * q[2]:
            want.append((r[0], text, r[2], r[3], len(text), *r[5:]))
    assert stage(spark, "quality_rules", rows, sf_dir) == sorted(want, key=str)


def test_line_dedup(spark, rows, sf_dir):
    some = rows[:50] + rows[-6:]
    gone = brute.repeated_lines([(x[0] if x[0] is not None else 1 << 62, x[1]) for x in some], min_words=1)
    want = []
    for n, r in enumerate(some):
        if gone[n] and (r[0], r[1]) not in {(x[0], x[1]) for x in some[:n]} or gone[n]:
            text = "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in gone[n])
            r = (r[0], text, r[2], r[3], len(text), *r[5:])
        want.append(r)
    got = stage(spark, "line_dedup", some, sf_dir)
    ids = lambda x: sorted((str(r[0]), r[1] or "") for r in x if r[0] != rows[5][0])  # noqa: E731  two texts share this id; their order is by hash
    assert len(got) == len(some) and ids(got) == ids(want)


def test_line_dedup_orders_words_by_all_texts(spark, sf_dir, monkeypatch):
    seen, rarity = [], linedups._rarity
    monkeypatch.setattr(linedups, "_rarity", lambda rows: seen.append(rarity(rows)) or seen[-1])
    texts = [f"word{i} common" for i in range(48)]
    stage(spark, "line_dedup", [(i, t, "en", "s", len(t), "g", 7) for i, t in enumerate(texts)] + [(90, None, None, None, None, "g", 7)], sf_dir)
    (steps,) = seen[0].first()
    bucket = spark.range(1).select(F.xxhash64(F.lit("common"))).first()[0] % linedups.BUCKETS
    assert steps[bucket] >> 54 == int(8 * math.log2(48))


def test_near_duplicates(spark, rows, sf_dir):
    found = brute.similar([x[:2] for x in rows])
    got = stage(spark, "near_duplicates", rows, sf_dir)
    kept = {r[0] for r in got}
    for (d, n, c), r in zip(found, rows, strict=True):
        if n == 0 or c is None or d == c:
            assert d in kept
        elif r[0] != rows[5][0]:
            assert d not in kept or d is None
    assert sum(r[0] == 9001 for r in got) == 1 and sum(r[0] is None for r in got) == 0


def test_near_duplicates_up_to_the_rule(spark, sf_dir):
    word = lambda g, a, z: [f"g{g}w{i}" for i in range(a, z)]
    texts = []
    for g, n in enumerate((60, 100, 400, 1500)):
        base = word(g, 0, n)
        longer = [base[: n // 2] + word(g, n, n + int(x * (n - 4))) + base[n // 2 :] for x in (0.17, 0.22, 0.3)]  # a passage put in
        shorter = [base[: n // 3] + base[n // 3 + int(x * (n - 4)) :] for x in (0.12, 0.17, 0.3)]  # one cut
        changed = [["other" if i % every == 7 else w for i, w in enumerate(base)] for every in (48, 100)]
        texts += [longer[1], base, *longer[::2], *shorter, *changed] if g % 2 else [base, *longer, *shorter, *changed]
        texts += [word(g, 5000, 5000 + n), word(g, 5000, 5000 + n) + word(g, 8000, 8000 + int(0.22 * (n - 4)))]  # a group of one such pair
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = [d for d, _, c in brute.similar(docs, k=5, percent=80) if d == c]
    assert len(want) < len([d for d, _, c in brute.similar(docs) if d == c])
    got = stage(spark, "near_duplicates", [(d, t, "en", "s", len(t), "g", 7) for d, t in docs], sf_dir)
    assert sorted(r[0] for r in got) == want


def test_decontaminate(spark, rows, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = [r for r, x in zip(rows, brute.leaks([x[:2] for x in rows], items), strict=True) if not x[5]]
    assert stage(spark, "decontaminate", rows, sf_dir) == sorted(want, key=str) and len(want) < len(rows)


def test_whole_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0 < out.count() == out.select("doc_id").distinct().count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontaminate", "encode"]
