"""Divergence of the sources of a language: how differently two sources use the language's terms.

A term is a run of letters A to Z (folded) and characters beyond ASCII. A language keeps the
terms of at least ``min_docs`` of its documents. A source gives a kept term the price
``1 + floor(10^9 (count + 2) / (N + 2 V))``, and two prices differ by
``floor((p - q)^2 / (p + q))``, the same both ways. Results are the sum over all kept terms
for each two sources of a language, and for each source the terms it uses most above its
language.

1. Each task counts (language, source, term) over slices of texts and adds up what it has
   before anything is shuffled. One shuffle by (language, term) gives counts and documents.
2. Kept terms are dealt into blocks by their hash; the number of blocks follows the number
   of kept rows, so a block is bounded, whatever the vocabulary. A block gives each source a
   sorted array of (term id, count), ids being ranks of the block's terms, and an empty one
   to sources without its terms. The block knows the language's own counts too, so the best
   terms of each source in it come from here; the best of all blocks are the result.
3. A pair task is one unordered pair of sources in one block: a galloping intersection of the
   two arrays prices what both use, the rest of each array what one uses, and the number of
   other terms what neither uses. Blocks are summed for each pair. Languages with many
   sources are dealt into tiles, so that no task has all pairs.

All arithmetic is exact in 64 bits; a language of 9 * 10^15 words and more counts in Python
integers.

Defined cases: null text, lang and source are ''; a document counts once for each of its
rows; sources without kept terms have every pair (0 where the language keeps none) and no
terms; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from gable.llm.common import read
from gable.llm.tokens import flat, give_back, pieces
from gable.runtime import fits_broadcast, row_count, stage

SCALE = 1_000_000_000
MIN_DOCS = 10
TOP = 10
#: Terms and rows of a block, on average; sources of a tile; counted rows a task holds before it gives them away.
BLOCK_TERMS, BLOCK_ROWS, TILE, HELD = 16_384, 1_000_000, 64, 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, dtype=bool)
_TERM[97:123] = _TERM[128:] = True

COUNTED = "lang string, source string, term string, n long, n_docs long"
BLOCKS = "lang string, block int, source string, ids array<int>, counts array<long>, total long, kept long, width int, top array<struct<item: string, value: long>>"


def terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all texts in order, and how many each text has."""
    data, offsets = flat(column)
    data = _LOWER[data]
    inside = _TERM[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    packed = data[inside]  # all terms end to end
    before = np.concatenate(([0], np.cumsum(inside)))
    bounds = np.append(before[starts], len(packed)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
    return found, np.diff(np.searchsorted(starts, offsets))


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Counts of (language, source, term) in one slice."""
    found, per_text = terms(batch.column("text"))
    coded = found.dictionary_encode()
    names, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    d = max(1, len(names))
    places, counts = np.unique(np.repeat(np.arange(len(per_text)), per_text) * d + codes, return_counts=True)
    langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    keys = group[places // d] * d + places % d
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    group, code = keys[heads] // d, keys[heads] % d
    n = np.add.reduceat(counts, heads) if len(heads) else counts
    columns = {
        "lang": langs.dictionary.take(pa.array(group // len(sources.dictionary))),
        "source": sources.dictionary.take(pa.array(group % len(sources.dictionary))),
        "term": names.take(pa.array(code)).cast(pa.string()),
        "n": pa.array(n.astype(np.int64)),
        "n_docs": pa.array(np.diff(np.append(heads, len(keys))).astype(np.int64)),
    }
    return pa.table(columns)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences and documents, whole sums."""

    def rows(batches):
        held: list[pa.Table] = []
        size = 0

        def combined() -> pa.Table:
            both = pa.concat_tables(held)
            return both.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("n_docs", "sum")]).rename_columns(both.column_names)

        for batch in pieces(batches):
            held.append(_counted(batch))
            size += held[-1].num_rows
            if size > HELD:
                held = [combined()]
                size = held[0].num_rows
                if size > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=65_536)
                    held, size = [], 0
        if held:
            yield from combined().to_batches(max_chunksize=65_536)
        give_back()

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = named.mapInArrow(rows, COUNTED).repartition("lang", "term")
    return parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows of ``term_counts`` whose term is in ``min_docs`` documents of its language, with ``total`` in the language and ``first`` of its rows."""
    term = Window.partitionBy("lang", "term")
    one = term.orderBy("source")
    seen = counts.select("lang", "source", "term", "n", F.sum("n").over(term).alias("total"), F.sum("n_docs").over(term).alias("docs"), (F.row_number().over(one) == 1).alias("first"))
    return seen.where(F.col("docs") >= min_docs).drop("docs")


def prices(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(SCALE (count + 2) / (total + 2 kept))``, exactly."""
    base = total + 2 * kept
    rest = counts.astype(np.int64) + 2
    if base >= (1 << 63) // 1000:
        return np.array([1 + SCALE * int(x) // base for x in rest], dtype=np.int64)
    out = np.zeros(len(rest), dtype=np.int64)
    for _ in range(3):  # three decimal digits at a time
        digit, rest = np.divmod(rest * 1000, base)
        out = out * 1000 + digit
    return out + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of the sorted ``few`` the number of smaller ones among the sorted ``many``.

    Every 64th is placed first; the others walk on from there in doubling steps and halve the last one.
    """
    if len(many) < 8 * len(few):
        return np.searchsorted(many, few)
    padded = np.append(many, np.iinfo(many.dtype).max)
    low = np.repeat(np.searchsorted(many, few[::64]), 64)[: len(few)]
    step = np.ones(len(few), dtype=np.int64)
    while (on := padded[np.minimum(low + step - 1, len(many))] < few).any():
        low = np.where(on, low + step, low)
        step = np.where(on, step * 2, step)
    high = np.minimum(low + step - 1, len(many))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        smaller = open_ & (padded[middle] < few)
        low, high = np.where(smaller, middle + 1, low), np.where(open_ & ~smaller, middle, high)
    return low


def pair_price(a: tuple, b: tuple, width: int) -> int:
    """Sum over a block's ``width`` terms for two sources, each (ids, prices of these, price of an absent term)."""
    (few, p, p_absent), (many, q, q_absent) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    at = gallop(few, many)
    hit = at < len(many)
    hit[hit] = many[at[hit]] == few[hit]
    alone = np.ones(len(many), dtype=bool)
    alone[at[hit]] = False
    both = differences(p[hit], q[at[hit]]).sum()
    one = differences(p[~hit], np.int64(q_absent)).sum() + differences(np.int64(p_absent), q[alone]).sum()
    none = (width - len(few) - int(alone.sum())) * int(differences(np.int64(p_absent), np.int64(q_absent)))
    return int(both) + int(one) + none


def _lists(values: np.ndarray, bounds: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _block(rows: pa.Table) -> pa.Table:
    """All arrays of one block. Rows without term name the sources and bring their totals; a null source is the language."""
    source, term, n, kept = (rows.column(c).combine_chunks() for c in ("source", "term", "n", "kept"))
    head = term.is_null()
    who = pc.filter(source, head)
    totals, v = pc.filter(n, head).to_pylist(), pc.filter(kept, head).to_pylist()
    body = pc.invert(head)
    found, owner, n = pc.filter(term, body), pc.filter(source, body), pc.filter(n, body).to_numpy()
    of_lang = owner.is_null()
    names = pc.filter(found, of_lang)
    names = names.take(pc.sort_indices(names))  # in the order of their UTF-8 bytes
    ids = pc.index_in(found, value_set=names).to_numpy()
    who = who.to_pylist()
    place = {s: i for i, s in enumerate(who)}
    coded = owner.dictionary_encode()
    code = np.array([place[s] for s in coded.dictionary.to_pylist()] + [place[None]], dtype=np.int64)[coded.indices.fill_null(len(coded.dictionary)).to_numpy().astype(np.int64)]
    order = np.lexsort((ids, code))
    ids, n = ids[order].astype(np.int32), n[order]
    bounds = np.searchsorted(code[order], np.arange(len(who) + 1))
    lang = prices(n[bounds[place[None]] : bounds[place[None] + 1]], totals[place[None]], v[place[None]]) if len(names) else n[:0]
    top = []
    for i, s in enumerate(who):
        own, cut = ids[bounds[i] : bounds[i + 1]], n[bounds[i] : bounds[i + 1]]
        if s is None or not len(own):
            top.append([])
            continue
        p, q = prices(cut, totals[i], v[i]), lang[own]
        above = np.flatnonzero(p > q)
        value = differences(p[above], q[above])
        best = np.lexsort((own[above], -value))[:TOP]
        top.append([{"item": names[int(own[above[k]])].as_py(), "value": int(value[k])} for k in best])
    size = len(who)
    columns = {
        "lang": [rows.column("lang")[0].as_py()] * size,
        "block": pa.array([rows.column("block")[0].as_py()] * size, pa.int32()),
        "source": pa.array(who, pa.string()),
        "ids": _lists(ids, bounds, pa.int32()),
        "counts": _lists(n, bounds, pa.int64()),
        "total": pa.array(totals, pa.int64()),
        "kept": pa.array(v, pa.int64()),
        "width": pa.array([len(names)] * size, pa.int32()),
        "top": pa.array(top, pa.list_(pa.struct([("item", pa.string()), ("value", pa.int64())]))),
    }
    return pa.table(columns)


def blocks(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Sorted (term id, count) arrays of every source in every block of terms, written."""
    kept = stage(kept_terms(term_counts(docs), min_docs), "kept")
    langs = stage(kept.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("total")), "langs")
    largest = langs.agg(F.max("kept")).first()[0] or 0
    number = max(-(-largest // BLOCK_TERMS), -(-row_count(kept) // BLOCK_ROWS), 1)
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    heads = stage(groups.join(F.broadcast(langs) if fits_broadcast(langs) else langs, "lang", "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")), "sources")
    of_lang = heads.groupBy("lang").agg(F.first("total").alias("n"), F.first("kept").alias("kept")).select("lang", F.lit(None).cast("string").alias("source"), "n", "kept")
    heads = heads.select("lang", "source", "n", "kept").union(of_lang)
    heads = heads.select("lang", F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("block"), "source", F.lit(None).cast("string").alias("term"), "n", "kept")
    block = F.pmod(F.xxhash64("term"), F.lit(number)).cast("int").alias("block")
    none = F.lit(None)
    body = kept.select("lang", block, "source", "term", "n", none.cast("long").alias("kept"))
    whole = kept.where("first").select("lang", block, none.cast("string").alias("source"), "term", F.col("total").alias("n"), none.cast("long").alias("kept"))
    return stage(heads.union(body).union(whole).groupBy("lang", "block").applyInArrow(_block, BLOCKS), "blocks")


def pair_values(arrays: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of all two sources of a language, a before b."""

    def rows(batches):
        tables: dict[tuple[int, int], np.ndarray] = {}

        def priced(counts: np.ndarray, total: int, kept: int) -> tuple[np.ndarray, int]:
            small = tables.get((total, kept))
            if small is None:
                if len(tables) > 2000:
                    tables.clear()
                small = tables[total, kept] = prices(np.arange(1024), total, kept)
            p = small[np.minimum(counts, 1023)]
            high = counts >= 1024
            p[high] = prices(counts[high], total, kept)
            return p, int(small[0])

        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            lists = {c: (columns[c].values.to_numpy(), columns[c].offsets.to_numpy()) for c in ("ids_a", "ids_b", "counts_a", "counts_b")}
            plain = {c: columns[c].to_pylist() for c in ("total_a", "total_b", "kept", "width")}
            values = []
            for i in range(batch.num_rows):
                sides = []
                for s in "ab":
                    ids, counts = (v[o[i] : o[i + 1]] for v, o in (lists[f"ids_{s}"], lists[f"counts_{s}"]))
                    sides.append((ids, *priced(counts, plain[f"total_{s}"][i], plain["kept"][i])) if plain["kept"][i] else (ids, counts, 0))
                values.append(pair_price(*sides, plain["width"][i]) if plain["width"][i] else 0)
            yield pa.RecordBatch.from_arrays([columns["lang"], columns["a"], columns["b"], pa.array(values, pa.int64())], ["lang", "a", "b", "value"])

    named = arrays.where("source IS NOT NULL")
    most = named.where("block = 0").groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    tiles = -(-most // TILE)
    left = named.select("lang", "block", F.col("source").alias("a"), F.col("ids").alias("ids_a"), F.col("counts").alias("counts_a"), F.col("total").alias("total_a"), "kept", "width", F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int").alias("tile"))
    right = named.select("lang", "block", F.col("source").alias("b"), F.col("ids").alias("ids_b"), F.col("counts").alias("counts_b"), F.col("total").alias("total_b"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"))
    both = left.join(right, ["lang", "block", "tile"]).where("a < b").drop("block", "tile")
    return both.mapInArrow(rows, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by divergence, and terms above the language."""
    arrays = blocks(docs, min_docs)
    pairs = pair_values(arrays)
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", sides.alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    best = arrays.where("source IS NOT NULL").select("lang", "source", F.explode("top").alias("t")).select("lang", "source", F.lit("term").alias("part"), "t.item", "t.value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, best)]
    return ranked[0].union(ranked[1].where(F.col("rank") <= TOP))


def op12_source_divergence(spark, folder: str) -> DataFrame:
    return audit(read(spark, folder, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS d FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL HAVING sum(d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY ALL),
used AS (SELECT c.lang, c.source, c.term, c.n FROM counts c JOIN kept k ON c.lang = k.lang AND c.term = k.term),
groups AS (
  SELECT g.lang, g.source, coalesce(u.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM used GROUP BY ALL) u ON g.lang = u.lang AND g.source = u.source),
priced AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS cnt,
    1 + (1000000000 * (coalesce(u.n, 0) + 2)::HUGEINT) // (g.n + 2 * l.v)::HUGEINT AS p,
    1 + (1000000000 * (k.n + 2)::HUGEINT) // (l.n + 2 * l.v)::HUGEINT AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM priced WHERE cnt > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
