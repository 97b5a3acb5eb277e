"""Operators that work on Arrow batches: joins, repeats, models, tokens; and the pipeline."""

import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from llm_support import pairs, prose, table
from pyspark.sql import functions as F

import corpus_pipeline
from gable.llm import jaccard_join, language_model, quality_classifier, records, repeats, sentencepiece_tokens
from gable.llm.tokens import word_hashes
from gable.runtime import scratch_path


def changed(text, n, seed):
    """``text`` with ``n`` words replaced."""
    rng, words = random.Random(seed), text.split()
    for i in rng.sample(range(len(words)), min(n, len(words))):
        words[i] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(spark, odd):
    """Groups of near copies at all similarities, chains, and small sets."""
    rows = []
    for g in range(12):
        base = prose(5000 + g, [4, 12, 25, 60, 120, 300, 700][g % 7])
        rows += [(1000 + 40 * g + i, changed(base, i // 2, g * 100 + i)) for i in range(14)]
        rows += [(1000 + 40 * g + 20 + i, " ".join(base.split()[i:])) for i in range(6)]
    # a big group: every member differs from the base, so some pairs are links and some are not
    base = prose(77, 150)
    rows += [(9000 + i, changed(base, 1 + i % 5, i)) for i in range(150)]
    return table(spark, rows).unionByName(odd)


def test_word_hashes_equal_words():
    texts = ["A b", None, "", " \x0b", "ab a\tb\nAB", "é É"]
    hashes, counts = word_hashes(pa.array(texts))
    words = [w for t in texts for w in brute.WORD.findall(brute.low(t))]
    assert counts.tolist() == [2, 0, 0, 0, 4, 2]
    assert [[a == b for b in words] for a in words] == (hashes[:, None] == hashes[None, :]).tolist()


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
@pytest.mark.parametrize("piece", [8_000_000, 60_000])
def test_jaccard_join(copies, k, percent, piece, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIECE_BYTES", piece)
    docs = copies.withColumn("n", F.lit("mine"))
    got = jaccard_join.join(docs, jaccard_join.Rule(k, percent)).collect()
    expected = brute.near_groups([p for p in pairs(copies) if p[0] is not None], k, percent)
    assert len(got) == copies.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    nameless = by.pop(None)
    assert [(r.component_id, r.n_links) for r in nameless] == [(None, 0)]
    assert {d: (sorted(r.n_shingles for r in rs), rs[0].component_id) for d, rs in by.items()} == expected
    big = [r for r in got if (r.doc_id or 0) >= 9000]
    sets = {r.doc_id: brute.shingles(dict(pairs(copies))[r.doc_id], k) for r in big}
    for r in big[:20]:
        linked = {sets[d] for d in sets if sets[d] != sets[r.doc_id] and 100 * len(sets[d] & sets[r.doc_id]) >= percent * len(sets[d] | sets[r.doc_id])}
        assert r.n_links == len(linked)


def test_large_group_joins_heads_and_not_documents(spark, monkeypatch):
    """Edges given to the components grow with documents and pairs of pieces, not with their product."""
    monkeypatch.setattr(jaccard_join, "PIECE_DOCS", 250)
    counted, plain = [], jaccard_join.components
    monkeypatch.setattr(jaccard_join, "components", lambda edges: counted.append(edges.count()) or plain(edges))
    base = prose(3, 120)
    docs = table(spark, [(i, changed(base, 1, i)) for i in range(5000)])
    got = jaccard_join.join(docs, jaccard_join.Rule(3, 90)).select("component_id", "n_links").collect()
    assert {r.component_id for r in got} == {0} and min(r.n_links for r in got) > 2000
    pieces = 5000 // 250
    assert all(n <= 5000 + 2 * pieces**2 for n in counted[1:])


def test_sketches_are_compared_in_few_pieces(spark, monkeypatch):
    """A cluster that common passages hold together is dealt to few tasks by sketches, however long its texts."""
    dealt, plain = [], jaccard_join.pieces_of
    monkeypatch.setattr(jaccard_join, "PIECE_BYTES", 100_000)

    def pieces_of(members, *about):
        dealt.append(plain(members, *about))
        return dealt[-1]

    monkeypatch.setattr(jaccard_join, "pieces_of", pieces_of)
    base = prose(3, 120)
    docs = table(spark, [(i, changed(base, 1, i)) for i in range(600)])
    jaccard_join.join(docs, jaccard_join.Rule(3, 90)).count()
    sketched, counted = [frame.agg(F.max(F.size("tasks"))).first()[0] for frame in dealt]
    assert sketched <= 2 and counted >= 6


@pytest.mark.parametrize("block", [2048, 64])
def test_parts_by_blocks_are_those_of_all_pairs(block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rule, rng = jaccard_join.Rule(5, 80), np.random.default_rng(4)
    sets = []
    for i in range(300):
        new = rng.integers(0, 1 << 62, int(rng.integers(150, 900))).astype(np.uint64)
        sets.append(np.unique(np.concatenate((sets[-1][len(new) // 20 :], new[: len(new) // 20])) if i % 3 else new))
    n = np.array([len(s) for s in sets])
    packed = jaccard_join.folded([jaccard_join.sketch(s, rule) for s in sets])
    close = jaccard_join.hamming_bound(jaccard_join.signs(packed)) <= rule.differences(n[:, None] + n[None, :]) + 0.25
    rows = np.arange(300)
    assert (jaccard_join.near_parts(packed, n, rows, rows, rule) == jaccard_join.parts_of(close)).all()
    assert 1 < len(np.unique(jaccard_join.parts_of(close))) < 200
    left, right = rows[rows % 2 == 0], rows[rows % 2 == 1]
    across = close & ((rows[:, None] + rows[None, :]) % 2 == 1) | np.eye(300, dtype=bool)
    assert (jaccard_join.near_parts(packed, n, left, right, rule) == jaccard_join.parts_of(across)).all()


def test_documents_keep_one_head_and_heads_are_joined_once(spark):
    rng = random.Random(5)
    group = [(doc, head) for doc in range(40, 340) for head in rng.sample(range(40), 12)]
    other = [(1000, 900), (1001, 1000), (1001, 901), (1001, 901)]
    given = spark.createDataFrame(group + other, "doc long, head long")
    led = jaccard_join.led_to_smallest(given)
    parts = [dict(jaccard_join.components(x.selectExpr("doc AS a", "head AS b")).collect()) for x in (given, led)]
    assert parts[0] == parts[1] and len(set(parts[0].values())) == 2
    # 3600 pairs of one group before; now one for each document and some of the 40 heads
    assert led.where("doc < 900").count() <= 300 + 40 * 39 // 2 and led.where("doc BETWEEN 40 AND 899").count() == 300
    assert led.where("doc >= 900").count() == 3


def test_jaccard_join_empty(none, spark):
    assert jaccard_join.join(none, jaccard_join.Rule(3, 90)).count() == 0
    blank = jaccard_join.join(table(spark, [(1, None), (2, ""), (None, " ")]), jaccard_join.Rule(3, 90))
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in blank.collect()) == [("1", 0, 1), ("2", 0, 2), ("None", 0, None)]


def removed(docs):
    rows = repeats.numbered(docs)
    runs = repeats.removed_runs(rows).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    return sorted((str(r[0]), *tuple(r)[1:]) for r in rows.join(runs, "doc", "left").select("doc_id", "text", "runs").mapInArrow(repeats.remove, repeats.REMAINS).collect())


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeated_bytes(spark, odd, none, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_LEAST", hot)
    monkeypatch.setattr(repeats, "HOT_PART", 10**9)
    monkeypatch.setattr(repeats, "STRETCH", 4096)
    shared = prose(42, 40)
    rows = [(100 + i, f"{prose(300 + i, 20)} {shared[: 90 + 5 * i]} {prose(400 + i, 20)}") for i in range(12)]
    rows += [(200, "x" * 99), (201, "y" * 100), (202, "y" * 101), (203, "z" * 350), (204, prose(1, 60)), (205, (prose(9, 30) + "é") * 3)]
    docs = table(spark, rows)
    assert removed(docs) == sorted((str(x[0]), *x[1:]) for x in brute.repeats(rows))
    # repeated ids and null ids: in the order of ids (null first) and texts
    mixed = docs.unionByName(odd)
    ordered = sorted(pairs(mixed), key=lambda p: (p[0] is not None, p[0] or 0, (p[1] or "").encode()))
    assert removed(mixed) == sorted((str(x[0]), *x[1:]) for x in brute.repeats(ordered))
    assert removed(none) == []


def test_repeated_bytes_salts_follow_the_count(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PART_MOST", 50)
    anchors = spark.createDataFrame([(a,) for a, n in ((1, 120), (2, 51), (3, 50), (4, 1)) for _ in range(n)], "anchor long")
    # also of an input whose 64th is far above the bound
    for total, expected in ((64 * 10**6, {1: 3, 2: 2}), (222, {1: 3, 2: 2})):
        assert {r.anchor: r.salts for r in repeats.salted(anchors, total).collect()} == expected


def test_language_model(spark, odd, none, small):
    docs = odd.unionByName(small).withColumn("held_out", F.lit("mine"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = language_model.train(docs.where(~held))
    rows = pairs(docs)
    held_ids = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 == 2}
    plain = brute.Bigrams([t for i, t in rows if i not in held_ids], language_model.discounts)
    got = sorted((str(r.doc_id), r.held_out, *tuple(r)[2:5], round(r.base_score, 4), round(r.score, 4)) for r in language_model.score(docs, model, held).collect())
    expected = []
    for i, t in rows:
        n, known, total, base, score = plain.scores(t)
        expected.append((str(i), i in held_ids, n, known, total, round(base, 4), round(score, 4)))
    for a, b in zip(got, sorted(expected), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-7, abs=1e-3)
    contexts = [None, *list(plain.count)[:5]]
    for v in contexts:  # probabilities of all known words and the unknown one
        assert sum(plain.pair(v, w) for w in plain.count) + plain.pair(v, ("unknown",)) == pytest.approx(1)
    empty = language_model.train(none)
    assert [r.score for r in language_model.score(odd.limit(2), empty, F.lit(True)).collect()] == [0.0, 0.0]


def test_classifier(spark, none, odd):
    good = [(i, prose(i, 60 + i % 90)) for i in range(0, 600, 2)]
    bad = [(i, " ".join(w.upper() + "!!" for w in prose(i, 60 + i % 90).split())) for i in range(1, 600, 2)]
    docs = table(spark, good + bad).withColumn("label", F.lit("mine"))
    labels = spark.createDataFrame([(i, i % 2 == 0) for i in range(600)], "doc_id long, q boolean").select("doc_id", F.col("q").cast("int").alias("label"))
    held = F.col("doc_id") % 5 == 0
    model = quality_classifier.fit(docs, labels.where("doc_id % 5 <> 0").unionByName(labels.limit(1).selectExpr("null AS doc_id", "1 AS label")))
    got = quality_classifier.score(docs, model, held).where("held_out").collect()
    assert np.mean([(r.score >= 0.3) == (r.doc_id % 2 == 0) for r in got]) > 0.97
    scored = quality_classifier.score(odd, model, F.lit(False)).collect()
    assert len(scored) == 13 and all(0 <= r.score <= 1 for r in scored)
    single = quality_classifier.fit(docs, labels.where("label = 1"))
    assert {r.score for r in quality_classifier.score(odd, single, F.lit(False)).collect()} == {1.0}
    assert {r.score for r in quality_classifier.score(odd, quality_classifier.fit(docs, labels.limit(0)), F.lit(False)).collect()} == {0.5}
    assert quality_classifier.score(none, model, F.lit(False)).count() == 0


def word_tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_records(spark, odd, small, none):
    from tokenizers import Tokenizer

    extra = table(spark, [(2_000_000, "<|endoftext|> é́ a ́b x\x0by\x1cz　w don't 12")])
    docs = odd.unionByName(small).unionByName(extra).withColumn("path", F.lit(1))
    index = records.write_records(docs, word_tokenizer(), scratch_path(spark, "records"))
    library = Tokenizer.from_file(word_tokenizer())
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in pairs(docs)}
    got = records.read_records(index).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), len(ids[t]), zlib.crc32(np.array(ids[t], dtype="<u4").tobytes())) for i, t in pairs(docs))
    # starts are the running total in the order of ids
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(r.doc_id if r.doc_id is not None else -1 for r in got)
    assert records.read_records(records.write_records(none, word_tokenizer(), scratch_path(spark, "records"))).count() == 0


def test_record_frames():
    payload = b"abc" * 10
    data = np.frombuffer(b"12345" + records.frame(payload), dtype=np.uint8).copy()
    assert records.unframe(data, 5) == payload
    for at in (5, 14, 20, len(data) - 1):
        spoilt = data.copy()
        spoilt[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(spoilt, 5)


def test_sentencepiece(spark, odd, small, none):
    import sentencepiece

    path = sentencepiece_tokens.model_path()
    strange = ["", "  a  b ", "a▁b", "<s>hi</s> <0x0A>", "\U0001F600 \n\t x", "   ", " ", "▁", "é́ ﬁ", "x" * 3000, "\n \n"]
    docs = odd.unionByName(small).unionByName(table(spark, [(3_000_000 + i, t) for i, t in enumerate(strange)])).withColumn("ids", F.lit("mine"))
    got = sentencepiece_tokens.with_ids(docs, path).collect()
    reference = sentencepiece.SentencePieceProcessor(model_file=path)
    assert all(r.ids == reference.encode(r.text or "") for r in got) and len(got) == docs.count()
    model = sentencepiece_tokens.Pieces(path, decoding=True)
    ids, odd_parts = model.encode_batch(strange)
    assert sum(odd_parts) == 0 and not model.spoilt
    assert model.decode_batch(ids) == [sentencepiece_tokens.model_text(model, t) for t in strange]
    assert sentencepiece_tokens.with_ids(none, path).count() == 0
    digests = docs.select("doc_id", "text").mapInArrow(sentencepiece_tokens.digest(path), "doc_id long, n_tokens long, ids_crc32 long, n_reference long, round_trip boolean").collect()
    said = sorted((str(i), len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes()), 0, True) for i, x in ((i, reference.encode(t or "")) for i, t in pairs(docs)))
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in digests) == said


def test_sentencepiece_unigram():
    """A small unigram model written by hand, protobuf and all."""
    import struct

    def field(n, kind, body):
        return bytes([n << 3 | kind]) + (bytes([len(body)]) + body if kind == 2 else body)

    found = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -2.5, 1), ("▁", -3.0, 1), ("a", -3.5, 1)]
    data = b"".join(field(1, 2, field(1, 2, t.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for t, s, k in found)
    data += field(2, 2, field(3, 0, bytes([1]))) + field(3, 2, field(3, 0, b"\1") + field(4, 0, b"\0"))
    model = sentencepiece_tokens.parse_model(data)
    assert model["pieces"] == found and (model["kind"], model["trim"], model["prefix"]) == (1, False, True)
    tokenizer = sentencepiece_tokens.build_tokenizer(model)
    assert tokenizer.encode("▁ab▁a", add_special_tokens=False).tokens == ["▁ab", "▁a"]


def test_pipeline(spark, small, tmp_path):
    folder = str(tmp_path)
    base = prose(1, 200)
    bench = [prose(800 + i, 30) for i in range(3)]
    rows = [(i, prose(2000 + i, 150)) for i in range(60)]
    rows += [(100, base), (101, base), (102, changed(base, 2, 1)), (103, changed(base, 60, 2))]
    rows += [(110, f"{prose(50, 90)} {bench[0]} {prose(51, 90)}"), (111, f"{prose(52, 90)} mail me@mail.org now {prose(53, 90)}")]
    rows += [(120 + i, " ".join(w + "###" for w in prose(60 + i, 120).split())) for i in range(6)]
    rows += [(130, "too short"), (131, None), (None, prose(2005, 150)), (132, prose(71, 100)), (132, prose(71, 100))]
    docs = table(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in [*range(60), 100, 103, 110, 111, 132]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(map(str, [*range(60), 100, 103, 111, 132, None]))
    by = {r.doc_id: r for r in got}
    assert "<EMAIL>" in by[111].text and "@" not in by[111].text
    import sentencepiece

    reference = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_tokens.model_path())
    assert all(r.ids == reference.encode(r.text) and r.n_chars == len(r.text) for r in got)
    for name, step in corpus_pipeline.STAGES[:-1]:
        left = step(spark, docs.limit(0), folder)
        assert left.columns == docs.columns and left.count() == 0, name


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
