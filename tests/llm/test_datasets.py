"""Token alignment, the manifest and the mix against plain versions, on hand-made and given rows."""

from __future__ import annotations

import hashlib
import os
import random
import sys
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from ledgerloom.llm import alignment, merkle, mixing, queries, ranks  # noqa: E402

rng = random.Random(11)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, path int, n_a string, row int"
TEXTS = [None, "", " ", "\n\n", "one", "Hello there.\nGeneral  words\n", "a ▁ b", "é😀 你好 \x00 <s> <|endoftext|> </s>", "x" * 9000, "  lead", "trail  ", "ab " * 3000, "Ünïcode 123'll don't\t!!"]


def made():
    out = [(i, t, "en", f"s{i % 4}", 3) for i, t in enumerate(TEXTS)]
    out += [(100 + i, " ".join(rng.choice(TEXTS[5].split() + ["token", "tokens", "mix\nline"]) for _ in range(rng.randint(1, 400))), None, rng.choice(["big", "big", "s1", None, "", "é", "z😀"]), None) for i in range(60)]
    out += [(7, "same id other text", "en", "s3", 1), (None, "no id\n", "en", "big", None), (None, "no id\n", "en", "big", None), (5, TEXTS[5], "en", "s1", 3), (900, "alone\nhere", "en", "lone", 1)]
    return [(*r, "x", 1, "y", 2) for r in out]


ROWS = made()
NAMES = ("op11_alignment", "op12_manifest", "op13_mix")


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def key(row):
    return tuple((v is None, str(v)) for v in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


# token alignment


def byte_level(model):
    """The bytes of each id."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
    names = {i: t for t, i in model.get_vocab().items()}
    return lambda i: bytes(back[c] for c in names[i])


def aligned(docs):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    bytes_a = byte_level(a)
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    done, counts = [], Counter()
    for d, t in docs:
        x, y = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        if b"".join(map(bytes_a, x)) != b"".join(map(bytes_b, y)) or t and b"".join(map(bytes_a, x)) != (" " + t).encode():
            x, y = [], []
        groups, links, left, right, i, j, at_a, at_b = [], [], [], [], 0, 0, 0, 0
        while i < len(x) or j < len(y):  # the side that is behind takes its next token
            if at_a <= at_b and i < len(x):
                left.append(x[i])
                at_a += len(bytes_a(x[i]))
                i += 1
            else:
                right.append(y[j])
                at_b += len(bytes_b(y[j]))
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                links.append((left[-1], right[-1]))
                left, right = [], []
        counts.update(links)
        done.append((d, len(x), len(y), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, q), n in counts.items():
        best[q] = max(best[q], n)
    return [(d, m, n, len(k), len(k), sum(counts[p] == best[p[1]] for p in k), sum(counts[p] for p in k), brute.sha(g) if g else "") for d, m, n, k, g in done]


def test_alignment_of_hand_made_rows(spark, folder):
    got = queries.QUERIES["op11_alignment"](spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    same(got.collect(), aligned([r[:2] for r in ROWS]))


def test_alignment_of_given_rows(spark, sf_dir):
    docs = [tuple(r) for r in queries.documents(spark, sf_dir).collect()]
    same(queries.QUERIES["op11_alignment"](spark, sf_dir).collect(), aligned(docs))


def test_alignment_keeps_columns_and_writes_groups(spark, monkeypatch):
    import public_tokenizers

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    monkeypatch.setattr(alignment, "BLOCK", 500)  # many blocks
    done, counts = alignment.aligned(spark.createDataFrame(ROWS, SCHEMA), *paths)
    assert done.columns == ["doc_id", "lang", "source", "n_chars", "size", "path", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    same([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, brute.sha(r.groups) if r.groups else "") for r in done.collect()], aligned([r[:2] for r in ROWS]))
    assert counts.agg(F.sum("count")).first()[0] == done.agg(F.sum("n_links")).first()[0]


def test_words_of_texts_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model, own = Tokenizer.from_file(path), alignment.ByteLevel(path)
    model.encode_special_tokens = True
    letters = [chr(i) for i in range(0x250)]
    texts = [" " + x + c + y for c in letters for x in ("a", "1", " ", "'") for y in ("b", "2", "  z", "?")]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["".join(rng.choice("a b'\n\t  stre1!é\xa0") for _ in range(60)) for _ in range(3000)]
    ids, sizes = own.encode([*texts, "你好 😀 'll", "y" * 60_000])
    assert [model.encode(t, add_special_tokens=False).ids for t in texts] == [x.tolist() for x in __import__("numpy").split(ids, sizes.cumsum()[:-1])][: len(texts)]


def test_segments_are_encoded_once_and_as_within_their_text(monkeypatch):
    import public_tokenizers

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    signs = "a b'\n\t  stre1!\xe9\xa0\r<s>\x00,.\u2003\u200b\u2581\u4f60\U0001f600"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    monkeypatch.setattr(alignment, "MEMO", 300)  # segments are given up and learned again
    own = alignment.Aligner(alignment.ByteLevel(paths[0]), alignment.Pieces(paths[1]))
    want = aligned(list(enumerate(texts)))
    for lo in range(0, len(texts), 100):
        counts, pairs, n, places, groups = own.align(texts[lo : lo + 100], True)
        assert [(*c, g) for c, g in zip(counts.T.tolist(), groups, strict=True)] == [(*w[1:5], w[7]) for w in want[lo : lo + 100]]
        assert len(places) == counts[3].sum() == n.sum() and n.tolist() == [places.tolist().count(i) for i in range(len(pairs))]
    met = []
    monkeypatch.setattr(own.a, "encode_segments", lambda s, f=own.a.encode_segments: met.extend(s) or f(s))
    own._forget()
    own.align(["some words come again and again and again"] * 50, True)
    assert sorted(met) == sorted(set(met)) and " again" in met


# the manifest


def written(*fields):
    return "".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields)


def climbed(nodes, arity):
    """The root, and for each leaf the (left, right) siblings of every level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, at, strict=True):
            lo = i // arity * arity
            way.append(("".join(nodes[lo:i]), "".join(nodes[i + 1 : lo + arity])))
        nodes = [brute.sha("".join(nodes[lo : lo + arity])) for lo in range(0, len(nodes), arity)]
        at = [i // arity for i in at]
    return nodes[0], ways


def manifest(docs, arity=3):
    trees = defaultdict(list)
    for d, text, lang, source, n in docs:
        trees[source].append((d, brute.sha(written(d, source, lang, n, text)), text, lang, n))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    done = {s: climbed([x[1] for x in sorted(trees[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))], arity) for s in names}
    root, tops = climbed([done[s][0] for s in names], arity)
    out = []
    for s, top in zip(names, tops, strict=True):
        for (d, leaf, text, lang, n), way in zip(sorted(trees[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1])), done[s][1], strict=True):
            whole = [*way, *top]
            if d is not None and zlib.crc32(str(d).encode()) % 2 == 0:
                text = text.replace("\n", "") if text is not None else None
            got = brute.sha(written(d, s, lang, n, text))
            for left, right in whole:
                got = brute.sha(left + got + right)
            out.append((d, leaf, done[s][0], root, brute.sha("".join(a + b for a, b in whole)), got, got == root))
    return out


def test_manifest_of_hand_made_rows(spark, folder):
    rows = queries.QUERIES["op12_manifest"](spark, folder).collect()
    same(rows, manifest([r[:5] for r in ROWS]))
    assert {r.verified for r in rows} == {True, False}


def test_manifest_matches_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(queries.SQL["op12_manifest"]).fetchall()
    same(queries.QUERIES["op12_manifest"](spark, sf_dir).collect(), want)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    same(manifest(docs), want)


@pytest.mark.parametrize("arity", [2, 5])
def test_manifest_of_other_arity(spark, arity):
    rows = [(i, "s" if i % 3 else "t", brute.sha(str(i)), "clash") for i in range(29)]
    done = merkle.manifest(spark.createDataFrame(rows, "doc_id int, source string, leaf string, root string"), arity=arity)
    assert done.columns == ["doc_id", "source", "leaf", "path", "subroot", "root"]
    got = done.select("doc_id", "root", merkle.fold(F.col("leaf"), F.col("path")).alias("folded")).collect()
    parts = [climbed([r[2] for r in rows if r[1] == s], arity)[0] for s in "st"]
    root = climbed(parts, arity)[0]
    assert len(got) == 29 and {(r.root, r.folded) for r in got} == {(root, root)}


def test_a_lone_leaf_is_its_own_root(spark):
    done = merkle.manifest(spark.createDataFrame([(1, None, "ab" * 32)], "doc_id int, source string, leaf string")).first()
    assert done.path == [] and done.subroot == done.root == "ab" * 32


# the mix


def sized(text):
    return len(brute.WORDS.findall(text or ""))


def wanted(sizes, share=1.5, times=2):
    """Targets by sharing again what is over."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    got, over, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while over > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            got[s] += over * weight[s] / total
        over = sum(max(0.0, got[s] - times * sizes[s]) for s in names)
        for s in names:
            if got[s] >= times * sizes[s]:
                got[s] = float(times * sizes[s])
                free.discard(s)
    return got


def check_mix(rows, docs):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in rows) == sorted((d is None, d or 0, sized(t)) for d, t, _ in docs)
    sizes, of = defaultdict(int), defaultdict(set)
    for d, t, s in docs:
        sizes[s] += sized(t)
        of[d, sized(t)].add(s)
    target = wanted(sizes)
    taken, clear = defaultdict(int), set(sizes)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        s = of[r.doc_id, r.size]
        if len(s) == 1:
            (one,) = s
            assert r.source_size == sizes[one] and r.target == pytest.approx(target[one])
            taken[one] += r.taken
        else:
            clear -= s
    for s in clear:
        assert abs(taken[s] - target[s]) <= max(2 * mixing.BLOCK, 0.02 * target[s]), s


def test_mix_of_hand_made_rows(spark, folder):
    rows = queries.QUERIES["op13_mix"](spark, folder).collect()
    check_mix(rows, [(r[0], r[1], r[3]) for r in ROWS])
    same(queries.QUERIES["op13_mix"](spark, folder).collect(), [tuple(r) for r in rows])


def test_mix_of_given_rows(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    check_mix(queries.QUERIES["op13_mix"](spark, sf_dir).collect(), docs)


def test_slots_hold_the_words_of_their_blocks(spark):
    rows, mixed = mixing.mix(spark.createDataFrame(ROWS, SCHEMA).drop("path"), block=16, shard=32)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_a", "row", "size", "source_size", "target", "rank"]
    docs = rows.collect()
    stream = defaultdict(list)
    for r in sorted(docs, key=lambda r: r.row):
        stream[r["rank"]] += brute.WORDS.findall(r.text or "")
    slots = mixing.slot_texts(mixed).collect()
    for r in slots:
        assert r.text == " ".join(stream[r["rank"]][16 * r.block : 16 * r.block + 16])
    times = Counter((r["rank"], r.block) for r in slots)
    assert max(times.values()) <= 2 and len({(r.shard, r.slot) for r in slots}) == len(slots)
    per_shard = Counter(r.shard for r in slots)
    assert len(per_shard) > 5 and all(n == 32 for s, n in per_shard.items() if s < max(per_shard))
    share = {r["rank"]: r.target for r in docs}
    most = max(share, key=share.get)  # each shard draws its own counts: they differ, and their mean is the source's share
    drawn = [sum(r["rank"] == most for r in slots if r.shard == s) for s in per_shard if s < max(per_shard)]
    assert len(set(drawn)) > 1 and abs(sum(drawn) / len(drawn) / 32 - share[most] / sum(share.values())) < 0.1


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_places_are_permuted(spark, n):
    image = lambda turn: [r[0] for r in spark.range(n).orderBy("id").select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit(turn))).collect()]
    a, b = image(0), image(1)
    assert sorted(a) == sorted(b) == list(range(n)) and (n < 64 or (a != b and sum(x == i for i, x in enumerate(a)) < n / 4))


# places in a part


@pytest.mark.parametrize("value", [None, "v"])
def test_places_and_sums(spark, value):
    rows = [(rng.choice(["a", "a", "a", None, "b"]), rng.randint(0, 30), i, rng.choice([None, i])) for i in range(500)]
    got = ranks.placed(spark.createDataFrame(rows, "p string, o int, i int, v int").repartition(7), ["p"], ["o", "i"], value).collect()
    assert len({r.row for r in got}) == 500
    for p in ("a", None, "b"):
        mine = sorted([r for r in rows if r[0] == p], key=lambda r: (r[1], r[2]))
        found = {r.i: r for r in got if r.p == p}
        for place, r in enumerate(mine):
            assert found[r[2]].place == place and (not value or found[r[2]].before == sum(x[3] or 0 for x in mine[:place]))


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_digest_is_of_utf8():
    assert brute.sha("é") == hashlib.sha256("é".encode()).hexdigest()
