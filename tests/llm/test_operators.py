"""The operators against brute-force versions: on the given tables, and on hand-made rows with nulls, ties and odd texts."""

from __future__ import annotations

import json
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from ledgerloom import session  # noqa: E402
from ledgerloom.llm import chats, fm, found, leaks, linedups, lines, passages, persons, pieces, queries, secrets, similar, toxicity  # noqa: E402

rng = random.Random(5)
VOCABULARY = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu") for b in ("n", "r", "s", "t", "x", "zé")]


def prose(n: int) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


def changed(words: list[str], n: int) -> list[str]:
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**6)}"
    return out


_LONG = prose(400)
_SHORT = prose(60)
#: nulls in every column, empty and white texts, ties, repeated rows, rows that share a doc_id, near copies, a very long text
ROWS: list[tuple[int | None, str | None]] = [
    (1, " ".join(_LONG)), (2, " ".join(_LONG)), (2, " ".join(_LONG)), (3, " ".join(changed(_LONG, 8))), (4, " ".join(changed(_LONG, 40))),
    (5, " ".join(_SHORT)), (6, " ".join(changed(_SHORT, 1)).upper()), (7, " ".join(_SHORT[:58])), (8, None), (9, ""), (10, " \n\t "), (11, "one"), (12, "ONE"), (13, "one two three"),
    (14, "one two three four"), (15, "a a a a a a a a"), (16, "a a a a a a"), (17, "\n".join([" ".join(_SHORT[:20])] * 3)), (18, "x" * 5000), (19, " ".join(["same words here again"] * 300)),
    (20, " ".join(_LONG) + "\n" + " ".join(_SHORT)), (21, "\x00   é😀 ▁▁ <s> \\ | $$$"), (21, "another text of the same id"), (None, " ".join(_LONG)), (None, "no id here"),
    (22, " ".join(prose(3000))), (23, " ".join(_SHORT[:30]) + "\r\n" + " ".join(_SHORT[30:])), (24, "one two three four"),
]
for _n in range(30, 60):
    ROWS.append((_n, " ".join(changed(_LONG[:120], rng.choice((0, 1, 2, 3, 6, 12))))))


def key(row):
    return tuple((v is None, str(v)) for v in row)


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.selectExpr("*", "'x' AS n_words", "1 AS ids", "'y' AS score", "2 AS removed") if extra else df


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


@pytest.fixture
def tables(spark, sf_dir, tmp_path):
    """A folder with hand-made documents and the given other tables."""
    frame(spark, ROWS).coalesce(3).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("benchmark", "labels", "conversations"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def empty(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


BRUTE = {
    "op1_pieces": lambda d, i: brute.pieces(d, queries.vocabulary()), "op3_secrets": lambda d, i: brute.secrets(d), "op5_similar": lambda d, i: brute.similar(d), "op7_leaks": brute.leaks,
    "op8_lines": lambda d, i: brute.quality(d), "op9_persons": lambda d, i: brute.persons(d), "op10_passages": lambda d, i: brute.passages(d),
}
#: columns of the contract; the rest is the method's
WIDTH = {"op1_pieces": 4, "op3_secrets": 5, "op5_similar": 3, "op7_leaks": 6, "op8_lines": 7, "op9_persons": 6, "op10_passages": 4}


def check(spark, name, folder, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    df = queries.QUERIES[name](spark, folder)
    assert got(df, *df.columns[: WIDTH[name]]) == sorted((tuple(r) for r in BRUTE[name](docs, items)), key=key)


@pytest.mark.parametrize("name", BRUTE)
def test_hand_made_rows(spark, tables, name):
    check(spark, name, tables, ROWS)


@pytest.mark.parametrize("name", BRUTE)
def test_given_rows(spark, sf_dir, given, name):
    check(spark, name, sf_dir, given)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == (1 if name == "op4_chats" else 0)


def test_pieces_equal_the_library_on_odd_texts():
    import sentencepiece

    path = queries.vocabulary()
    own, model = pieces.Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    letters = "aeionrstl EPRbcdfBjv/=+0123456789\n_▁"
    texts = [" " * n + "x" * (n % 3) + " " * (n // 2) for n in range(60)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for _ in range(200)] + ["".join(rng.choice("aeionrstlcdfBasejv") for _ in range(3000)), "\u0000�😀é"]
    ids, bounds = own.encode(texts)
    for text, a, z, back in zip(texts, bounds[:-1], bounds[1:], own.decode(ids, bounds), strict=True):
        want = model.encode(text, add_bos=True, add_eos=True)
        assert ids[a:z].tolist() == want and back == model.decode(want)


def test_lines_go_as_in_brute_force(spark):
    base = ["alpha beta gamma delta epsilon zeta eta theta iota kappa", "one two three four five six seven"]
    text = ["\n".join([base[0], base[1]]), base[0].upper() + "\nshort line", base[0] + " lambda", base[0].replace("alpha beta", "x y z"), base[1] + "\n" + base[1], "a b c d\na b c d", None, ""]
    docs = [(i, t) for i, t in enumerate(text)] + [(50, text[0]), (50, text[0])]
    docs += [(100 + i, "\n".join(" ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(3, 9))) for _ in range(8))) for i in range(60)]
    out = linedups.drop_lines(frame(spark, docs), out="left_text")
    want = brute.repeated_lines(docs)
    rows = got(out, "doc_id", "text", "removed", "left_text")
    assert len(rows) == len(docs)
    for d, t, removed, left in rows:
        n = docs.index((d, t))
        assert removed == want[n]
        assert left == (t if not removed else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in removed))


def test_lines_go_on_given_rows(spark, sf_dir, given):
    some = given[:60]
    want = brute.repeated_lines(some)
    rows = got(linedups.drop_lines(frame(spark, some)), "doc_id", "removed")
    assert rows == sorted(((d, want[n]) for n, (d, _) in enumerate(some)), key=key)


def test_signatures_are_packed_and_meet(spark):
    draw, parts, width = random.Random(7), 5, 6
    sets = [(draw.getrandbits(63) & similar._mask(width), draw.randrange(1 << 62), [draw.getrandbits(64) for _ in range(300)]) for _ in range(40)]
    sets += [(node, doc + 1, sig) for node, doc, sig in sets[:3]]  # equal sets
    sets += [(draw.getrandbits(40), draw.randrange(1 << 62), sets[9][2][:20] + sets[4][2][:5] + [draw.getrandbits(64) for _ in range(50)]) for _ in range(6)]
    tasks, met = [[(similar._placed(np.array(s, np.uint64), parts), n, d) for n, d, s in sets[i::3]] for i in range(3)], []
    rows = [r for task in tasks for b in similar._met(task, width, parts) for r in b.to_pylist()]
    entries = sum(len(set(np.concatenate([x[0] for x in task]).tolist())) for task in tasks)
    assert sum(len(r["packed"]) for r in rows if r["part"] >= 0) == (similar.SIGN + width) * entries and len(rows) <= 6 * parts
    for part in {r["part"] for r in rows}:
        table = similar._apart(similar.pa.table({"part": [part] * sum(r["part"] == part for r in rows), "packed": [r["packed"] for r in rows if r["part"] == part]}), width)
        met += [(r["sig"], r["node"]) for r in table.to_pylist()]
        assert all(r["lead"] is None or r["lead"] in {n for n, *_ in sets} - {r["node"]} for r in table.to_pylist())
    holders = {}
    for task in tasks:
        for sig, n, _ in task:
            for x in sig.tolist():
                holders.setdefault(x, {})[n] = None
    assert set(met) == {(x, n) for x, nodes in holders.items() if len(nodes) > 1 for n in nodes}


def test_scratch_tables_go_with_their_step(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    docs = spark.createDataFrame([(d, t) for d, t in ROWS], "doc_id bigint, text string")
    found, gone = similar.near_duplicates(docs), linedups.repeated_lines(docs, min_words=1)
    assert sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()) == ["line-removed", "similar-found"]
    assert found.count() == len(ROWS) and gone.count() > 0  # read after the rest is gone


def test_rarity_counts_the_words_of_all_texts(spark):
    texts = [f"w{i} common\nCOMMON w{i}" for i in range(40)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("xxhash64(text) AS txt", "text")
    (steps,) = linedups._rarity(rows).first()
    at = lambda w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] % linedups.BUCKETS
    assert steps[at("common")] >> 54 == 50 and [steps[at(f"w{i}")] >> 54 for i in range(40)] == [8] * 40


def test_short_lines_go(spark, tmp_path):
    draw = random.Random(5)
    short = ["Share this page", "share  THIS page", "one", "a b c d", "a b c d e", "a b c e", " ", "", "d c b a " * 50, "read more here", "All rights reserved."]
    docs = [(i, "\n".join(draw.sample(short, 6) + [draw.choice(["w x y z", "w x y z v", "w x y", "w x"])] * 2)) for i in range(40)] + [(90, None), (91, "one"), (91, "one")]
    want = brute.repeated_lines(docs, min_words=1)
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    for d, removed in got(queries.QUERIES["op6_linedups"](spark, str(tmp_path)), "doc_id", "removed_lines"):
        assert removed == ",".join(map(str, want[[x for x, _ in docs].index(d)])), d
    assert any(want.values()) and not any(brute.repeated_lines([(0, "one\none")]).values())


def test_line_rules():
    assert [lines.line_fails(x) for x in ("A plain sentence of words.", "", "Home", "As.", "Home | About | Contact | Login", "WOW!! BUY!! NOW!! THIS!!", "All rights reserved.")] == [
        "", "", "navigation", "", "navigation", "punctuation", "boilerplate",
    ]
    assert lines.clean("A good line of words.\nHome | Shop | Cart\nMore good words here.") == ("A good line of words.\nMore good words here.", 1, 14)


def test_rejected_for_lost_text(spark):
    good = "\n".join(" ".join(f"word{12 * i + j}" for j in range(12)) + "." for i in range(6))
    bad = "\n".join(" | ".join(f"word{12 * i + j}" for j in range(12)) for i in range(8)) + "\n" + " ".join(prose(12)) + "."
    rows = {r.doc_id: r for r in lines.quality(frame(spark, [(1, good), (2, bad), (3, None)])).collect()}
    assert rows[1].kept and rows[1].cleaned == good and not rows[2].kept and not rows[2].base_failed and rows[3].base_failed and rows[3].cleaned is None


def test_weak_credentials_need_partners(spark):
    value = "q9Zx81Lm0Pq7Rt5Vw3Yz2Ab4"
    docs = [(1, f"user: alice then {value} here"), (2, f"only {value} here"), (3, "user: alice " + "word " * 200 + value), (4, "see https://db.example.com/x and user = bob"), (5, "token=abcdefgh1 user=carol"), (6, None)]
    rows = {r.doc_id: found_kinds(r.spans) for r in secrets.scan(frame(spark, docs)).collect()}
    assert rows == {1: ["weak_identifier", "weak_value"], 2: [], 3: [], 4: ["weak_endpoint", "weak_identifier"], 5: ["assign", "weak_identifier"], 6: []}


def found_kinds(spans):
    return [x.kind for x in spans]


def test_assignments_are_not_retried(spark):
    docs = [(1, "token=secret: abcdefghij"), (2, "PASSWORD = 'abcdefgh'"), (3, "api-key=abcdefghi"), (4, "é api_key:abcdefgh9")]
    rows = {r.doc_id: [(x.kind, x.s, x.e) for x in r.base] for r in secrets.scan(frame(spark, docs)).collect()}
    assert rows == {1: [], 2: [("assign", 0, 20)], 3: [], 4: [("assign", 2, 19)]}


def test_contexts_find_unseen_identifiers(spark):
    docs = [(i, f"please reach me at user{i}@mail.example.com today") for i in range(6)] + [(10, "you may reach me at AB-99871 instead"), (11, "the order was AB-12345 then"), (12, None)]
    rows = {r.doc_id: [(x.kind, x.s, x.e) for x in r.spans] for r in persons.scan(frame(spark, docs)).collect()}
    assert rows[10] == [("context", 20, 28)] and rows[11] == [] and rows[12] == [] and rows[0][0][0] == "email"


@pytest.mark.parametrize("seed", range(3))
def test_index_statistics(seed):
    r = np.random.default_rng(seed)
    words = r.integers(1, 6, 400).astype(np.uint64)
    bounds = np.array([0, 30, 31, 200, 400])
    index = fm.Index(words, bounds, 4)
    query = r.integers(1, 8, 300).astype(np.uint64)
    parts = np.array([0, 100, 300])
    ends, length, _ = index.statistics(query, parts, 4)
    held = {tuple(words[i : i + n]) for a, z in zip(bounds[:-1], bounds[1:], strict=True) for n in range(1, 5) for i in range(a, z - n + 1)}
    want = [(e, max([n for n in range(1, 5) if tuple(query[e - n + 1 : e + 1]) in held], default=0)) for a, z in zip(parts[:-1], parts[1:], strict=True) for e in range(a + 3, z)]
    assert list(zip(ends, length, strict=True)) == want


@pytest.mark.parametrize("plan", [(None,), (0,), (1,), (0.5,)])
def test_every_similar_pair_meets(plan):
    """For all kinds of segments, with and without spare ones, similar sets have a signature in common."""
    r = np.random.default_rng(9)
    bands = similar.Bands(85)
    for size in (7, 9, 14, 30, 75, 200, 420):
        bands.plan = {}
        for band in {b for n in range(max(1, int(size * 0.8)), int(size * 1.2) + 2) for b in bands.of(n)}:
            h = bands.differ(band)
            if h < 1:
                continue
            if plan[0] is None:
                bands.choose({band: 1000})
            else:
                spare = 0 if plan[0] == 1 else 3
                ones = int((h + 1 + spare) // 2 * plan[0])
                bands.plan[band] = (h + 1 + spare - 2 * ones, ones, min(spare, h + 1 + spare - 2 * ones))
        for _ in range(60):
            a = r.integers(0, 1 << 63, size).astype(np.uint64)
            keep = a[r.random(size) > 0.05]
            b = np.concatenate([keep, r.integers(0, 1 << 63, int(r.integers(0, max(2, size // 12)))).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both) and len(a) != both | len(b) != both:
                assert len(np.intersect1d(bands.signatures(a), bands.signatures(b))) or np.array_equal(a, b)


def test_leaks_in_blocks_and_odd_items(spark):
    items = spark.createDataFrame([(1, " ".join(_LONG[:25])), (2, "One, two; THREE"), (None, "two three"), (3, None), (4, ""), (5, "zzz"), (1, "four")], "item_id bigint, text string")
    docs = frame(spark, ROWS)
    one = got(leaks.find_leaks(docs, items), "doc_id", "n_words", "hits", "items")
    many = got(leaks.find_leaks(docs, items, block=40), "doc_id", "n_words", "hits", "items")
    want = brute.leaks(ROWS, [("" if r.item_id is None else r.item_id, r.text) for r in items.collect()])
    assert one == many
    assert sorted((d is None, str(d), sum(h[1::2]) - sum(h[::2]), len(i)) for d, _, h, i in one) == sorted((x[0] is None, str(x[0]), x[2], x[3]) for x in want)


def test_leaks_of_one_passage_in_many_documents_and_clashing_names(spark):
    passage = " ".join(_LONG[:30])
    docs = [(i, f"word{i} {passage} {passage if i % 3 else ''} tail{i}") for i in range(40)] + [(100, "apart " * 6000 + passage), (101, None), (101, None), (None, passage)]
    items = [("a", passage), ("a", passage), ("b", passage + " more"), ("c", "apart apart"), ("d", None)]
    rows = frame(spark, docs, extra=False).selectExpr("*", "1 AS k1", "'x' AS k2", "2 AS shingle", "'y' AS context", "3 AS part", "4 AS words", "'z' AS item", "5 AS hits", "6 AS n_words", "7 AS begin")
    found = leaks.find_leaks(rows, spark.createDataFrame(items, "item_id string, text string"))
    assert sorted(found.columns) == sorted(rows.columns + ["items"])
    assert {(r.k1, r.k2, r.shingle, r.context, r.part, r.words, r.item, r.begin) for r in found.collect()} == {(1, "x", 2, "y", 3, 4, "z", 7)}
    want = brute.leaks(docs, items)
    have = [(r.doc_id, r.n_words, r.n, len(r.items)) for r in found.withColumn("n", leaks.hit_words()).collect()]
    assert sorted(have, key=str) == sorted(((x[0], x[1], x[2], x[3]) for x in want), key=str)


def test_toxicity_learns_and_holds_out(spark):
    bad = ["vile", "nasty", "gross", "awful"]
    docs = [(i, " ".join(prose(40) + (rng.sample(bad, 3) if i % 5 == 0 else []))) for i in range(1200)] + [(5000, None), (5001, ""), (None, "vile nasty")]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 1200, 2)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    rows = frame(spark, docs)
    model = toxicity.train(rows, labels)
    done = {r.doc_id: r for r in toxicity.score(rows, model).withColumn("held", toxicity.held_out()).collect()}
    held = [i for i in range(1200) if done[i].held]
    right = sum((done[i].score >= 0.5) == (i % 5 == 0) for i in held)
    assert len(held) > 150 and right >= 0.95 * len(held) and done[5000].score == done[5001].score and done[None].score >= 0.5
    assert toxicity.train(rows, labels.where("toxic = 0")) is None and toxicity.score(rows, None).select("score").distinct().count() == 1


def test_chat_layouts_round_trip(spark):
    nasty = "\\### Assistant: </turn> ok <turn user>\n\\("
    records = [
        {"messages": [{"role": "user", "content": nasty}, {"role": "assistant", "content": nasty}]}, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": nasty}], "id": 3},
        {"instruction": "do", "input": "", "output": "done"}, {"prompt": "p", "response": None}, {"question": "q", "answer": "r", "source": {"url": "u"}}, {"unknown": 1}, {"messages": []}, [],
    ]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(90, None), (91, "{broken")], "id int, record string")
    done = {r.id: r for r in chats.read_back(chats.format_records(rows.selectExpr("*", "1 AS layout"))).collect()}
    turns = lambda i: [(t.role, t.text) for t in done[i].turns]
    assert turns(0) == [("user", nasty), ("assistant", nasty)] and done[0].loss_text == nasty and turns(1) == [("user", "a"), ("assistant", nasty)]
    assert turns(2) == [("user", "do"), ("assistant", "done")] and turns(3) == [("user", "p"), ("assistant", "")] and turns(4) == [("user", "q"), ("assistant", "r")]
    assert done[4].fingerprint != done[3].fingerprint and [done[i].layout for i in (5, 6, 7, 90, 91)] == [None, "messages", None, None, None] and done[91].formatted == ""


def test_chats_match_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    assert got(queries.QUERIES["op4_chats"](spark, sf_dir), "*") == sorted((tuple(r) for r in con.execute(queries.SQL["op4_chats"]).fetchall()), key=key)


def test_spans_are_code_points(spark):
    df = spark.createDataFrame([("é😀 ab12 x cd34",), ("",), ("none",)], "t string").select(found.matches(__import__("pyspark").sql.functions.col("t"), "[a-z]{2}[0-9]{2}").alias("m"))
    assert [[(x.s, x.e, x.v, x.c) for x in r.m] for r in df.collect()] == [[(3, 7, "ab12", "é😀 "), (10, 14, "cd34", " x ")], [], []]


def test_passages_in_small_shards(spark):
    df = passages.cut_repeats(frame(spark, ROWS), shard_words=50)
    whole = passages.cut_repeats(frame(spark, ROWS))
    assert got(df, "doc_id", "n_words", "n_removed", "kept") == got(whole, "doc_id", "n_words", "n_removed", "kept")


@pytest.mark.parametrize("k, percent", [(4, 70), (3, 50), (5, 80), (2, 95)])
def test_links_at_any_similarity(spark, k, percent):
    draw, texts = random.Random(3), []
    for g in range(8):
        base = [f"g{g}w{draw.randrange(400)}" for _ in range(draw.choice([12, 40, 100, 300]))]
        for _ in range(7):
            t = list(base)
            for _ in range(draw.randrange(0, max(2, len(base) // 9))):
                i = draw.randrange(len(t))
                t[i : i + draw.randrange(0, 3)] = [f"y{draw.randrange(10**6)}" for _ in range(draw.randrange(0, 5))] or ["x"]
            texts.append(t)
    texts += [[f"a{i}" for i in range(98)], [f"a{i}" for i in range(138)]]  # one inside the other
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = similar.near_duplicates(frame(spark, docs), shingle=k, percent=percent)
    assert got(found, "doc_id", "n_shingles", "component_id") == sorted(brute.similar(docs, k, percent), key=key)


def test_long_identifiers_and_far_contexts(spark):
    docs = [(i, f"please reach me at user{i}@mail.example.com today") for i in range(6)]
    docs += [(10, "may reach me at AB-" + "7" * 64 + "x instead"), (11, "may reach me at" + " " * 60 + "CD-99871 instead"), (12, "me  at " + "." * 90 + " ABCDEFGHIJKLM-4711"), (13, "x" * 70 + " at 55555")]
    rows = {r.doc_id: [(x.kind, x.s, x.e) for x in r.spans] for r in persons.scan(frame(spark, docs)).collect()}
    assert rows[10] == [("context", 16, 84)] and rows[11] == [("context", 75, 83)] and rows[12] == [("context", 98, 116)] and rows[13] == []


def test_weak_values_of_any_length(spark):
    value = "z" * 60 + "9"
    rows = {r.doc_id: found_kinds(r.spans) for r in secrets.scan(frame(spark, [(1, f"user: alice then {value}"), (2, f"user: alice then {'z' * 60}"), (3, "user: alice then " + "8-" * 30 + "q")])).collect()}
    assert rows == {1: ["weak_identifier", "weak_value"], 2: [], 3: ["weak_identifier", "weak_value"]}


def test_keys_of_lines_are_plain_numbers(spark):
    keys = linedups._ordered(F.col("text"), F.expr("array_repeat(0L, 131072)"))
    done = frame(spark, [(1, "b a  B c"), (2, "")]).select(F.size(keys).alias("n"), keys.alias("keys"))
    assert not done.schema["keys"].dataType.containsNull  # such arrays are sorted without boxes
    assert sorted(r.n for r in done.collect()) == [0, 3]


def test_dropped_lines_beside_clashing_names(spark):
    rows = frame(spark, [(1, "one two three\nx"), (2, "one two three\ny")]).selectExpr("*", "1 AS gone", "'t' AS _gone", "2 AS gone_doc", "3 AS _gone_txt", "4 AS left_text")
    done = linedups.drop_lines(rows, min_words=1)
    assert done.columns == ["doc_id", "text", "n_words", "ids", "score", "gone", "_gone", "gone_doc", "_gone_txt", "left_text", "removed"]
    assert got(done, "doc_id", "left_text", "gone", "_gone") == [(1, "one two three\nx", 1, "t"), (2, "y", 1, "t")]
