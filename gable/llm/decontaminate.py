"""Benchmark decontamination by spaced-seed hashing.

A seed is two blocks of three tokens at one of four distances, given by a mask; the
tokens between them are ignored. The kept tokens of every benchmark place are hashed
once per mask; the same hashes of every training document are looked up in them.
Around each hit, benchmark item and document are laid on top of each other and
compared token by token: the document is contaminated if some ``OVERLAP`` aligned
tokens (or all of a shorter item) agree in at least ``AGREE`` of all places. Places
beyond the end of item or document count as disagreeing, so a passage at an edge is
found by as many equal tokens as one within. Items of fewer than ``SPAN`` tokens are
looked for as a whole and word for word, by one hash each, where ``short`` asks for it.

The masks find whatever that comparison accepts: 15 or 16 places hold five blocks
of three, of which 3 changed tokens spoil three at most, and 12 to 14 places hold
four, of which 2 spoil two; the two blocks left are at a distance of 3, 6, 9 or 12.

Two bit tables of fixed size (parameters) thin the positions before the lookup:
one of the first three kept tokens, which all masks share, one of whole seeds. They
have no false negatives, so they change the cost and never the result. The seed
table is broadcast up to a counted size and shuffled beyond it.

Everything is DataFrame functions. Defined cases: null and empty texts and items
match nothing; without ``short``, items of fewer than ``SPAN`` tokens match nothing
(such an item is hard to tell from ordinary text); rows without ``doc_id`` or ``item_id`` are not reported;
rows that repeat a ``doc_id`` are reported once for it; empty tables give no rows;
other columns are ignored. Tokens are lower-cased words between white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gable.llm.common import read, settled, sized_join, texts, words
from gable.runtime import stage

SPAN = 12
#: Places that each mask keeps: a block of three and a second one.
MASKS = tuple((0, 1, 2, at, at + 1, at + 2) for at in (3, 6, 9, 12))
#: Tokens that the narrowest seed covers.
NARROWEST = 6
#: Aligned tokens that are compared, and the share of them that must agree.
OVERLAP, AGREE = 16, 0.8
#: Tokens on each side of a hit that the comparison may use.
REACH = 64
#: Bits of the two tables, powers of two.
PAIR_BITS, SEED_BITS = 1 << 17, 1 << 20
#: Most seeds of the benchmark that are broadcast (each holds its item's hashes).
BROADCAST_SEEDS = 50_000


def token_hashes(text: Column) -> Column:
    return F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))


def seed(mask: int, at: str = "i") -> str:
    kept = ", ".join(f"__h[{at} + {o}]" for o in MASKS[mask])
    return f"CASE WHEN {at} + {MASKS[mask][-1]} < size(__h) THEN xxhash64({mask}, {kept}) END"


def bit_table(hashes: DataFrame, column: str, bits: int) -> str:
    """SQL literal of an array of longs that holds a bit for each hash of ``column``."""
    slots = hashes.select(F.pmod(column, F.lit(bits)).alias("b")).distinct()
    table = [0] * (bits // 64)
    for row in slots.groupBy(F.expr("cast(b div 64 AS int)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 AS int)))").alias("v")).collect():
        table[row.w] = row.v  # at most bits / 64 rows
    return f"cast(split('{','.join(map(str, table))}', ',') AS array<bigint>)"


def has_bit(table: str, hashed: str, bits: int) -> str:
    place = f"pmod({hashed}, {bits})"
    return f"getbit({table}[cast({place} div 64 AS int)], cast({place} % 64 AS int)) = 1"


def seeds_of(hashed: DataFrame, places: str) -> DataFrame:
    """Adds ``__seeds``: ``m, s, i`` of each mask and place of the array ``places``; ``s`` is null where a seed goes beyond the text."""
    each = ", ".join(f"struct({m} AS m, {seed(m)} AS s, i AS i)" for m in range(len(MASKS)))
    return settled(hashed, __seeds=f"flatten(transform({places}, i -> array({each})))")


def benchmark_seeds(benchmark: DataFrame, short: bool = False) -> DataFrame:
    """``s`` (seed), ``item_id``, ``ipos``, ``ih`` (token hashes of the item); repeated items count once, ``short`` ones have one seed."""
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).where("item_id IS NOT NULL").distinct()
    hashed = settled(items.select("item_id", "text"), __h=token_hashes(F.col("text")))
    starts = f"CASE WHEN size(__h) >= {SPAN} THEN sequence(0, size(__h) - {NARROWEST}) END"
    seeded = seeds_of(hashed, starts)
    if short:
        whole = "array(struct(-1 AS m, xxhash64(-size(__h), __h) AS s, 0 AS i))"
        seeded = settled(seeded.withColumnRenamed("__seeds", "__long"), __seeds=f"CASE WHEN size(__h) BETWEEN 1 AND {SPAN - 1} THEN {whole} ELSE __long END")
    rows = seeded.select("item_id", F.col("__h").alias("ih"), F.explode_outer("__seeds").alias("x"))
    return rows.where("x.s IS NOT NULL").select("item_id", "ih", F.col("x.s").alias("s"), F.col("x.i").alias("ipos"))


def with_short(kept: DataFrame, test: DataFrame, seed_table: str) -> DataFrame:
    """Adds to ``__hits`` the seed of each item of fewer than ``SPAN`` tokens in the document, once for each, without a stretch."""
    items = test.where(f"size(ih) < {SPAN}")
    sizes = sorted(r.n for r in items.select(F.size("ih").alias("n")).distinct().collect())  # fewer than SPAN rows
    if not sizes:
        return kept
    first_table = bit_table(items.select(F.expr("ih[0]").alias("t")), "t", PAIR_BITS)
    begun = settled(kept, __begin=f"array_compact(transform(__h, (t, i) -> CASE WHEN {has_bit(first_table, 't', PAIR_BITS)} THEN i END))")
    each = ", ".join(f"CASE WHEN i + {n} <= size(__h) THEN xxhash64(-{n}, slice(__h, i + 1, {n})) END" for n in sizes)
    whole = settled(begun, __whole=f"array_distinct(flatten(transform(__begin, i -> array({each}))))")
    found = f"filter(__whole, s -> s IS NOT NULL AND {has_bit(seed_table, 's', SEED_BITS)})"
    more = f"transform({found}, s -> struct(s AS s, 0 AS i, 0 AS lo, cast(null AS array<bigint>) AS dh))"
    return settled(whole.withColumnRenamed("__hits", "__long"), __hits=f"concat(__long, {more})")


def overlaps(docs: DataFrame, benchmark: DataFrame, short: bool = False) -> DataFrame:
    """``doc_id, item_id, matched, start``: verified overlaps, best one for each document and item; ``start`` is null for items below ``SPAN``."""
    test = stage(benchmark_seeds(benchmark, short), "seeds")
    blocks = test.where(f"size(ih) >= {SPAN}").select(F.expr("xxhash64(ih[ipos], ih[ipos + 1], ih[ipos + 2])").alias("p"))
    block_table, seed_table = bit_table(blocks, "p", PAIR_BITS), bit_table(test, "s", SEED_BITS)

    hashed = settled(texts(docs), __h=token_hashes(F.col("text"))).drop("text")
    near = f"transform(slice(__h, 3, greatest(size(__h) - {NARROWEST - 1}, 0)), (x, i) -> xxhash64(__h[i], __h[i + 1], x))"
    blocked = settled(hashed, __p=near)
    open_ = settled(blocked, __at=f"array_compact(transform(__p, (p, i) -> CASE WHEN {has_bit(block_table, 'p', PAIR_BITS)} THEN i END))")
    seeded = seeds_of(open_.drop("__p"), "__at")
    around = f"struct(x.s AS s, x.i AS i, greatest(x.i - {REACH}, 0) AS lo, slice(__h, greatest(x.i - {REACH}, 0) + 1, {2 * REACH + OVERLAP}) AS dh)"
    kept = settled(seeded, __hits=f"transform(filter(__seeds, x -> x.s IS NOT NULL AND {has_bit(seed_table, 'x.s', SEED_BITS)}), x -> {around})")
    if short:
        kept = with_short(kept, test, seed_table)
    hits = kept.select("doc_id", F.explode_outer("__hits").alias("x")).where("x IS NOT NULL AND doc_id IS NOT NULL")
    hits = hits.select("doc_id", "x.s", "x.i", "x.lo", "x.dh")

    # one comparison for each alignment and stretch of REACH tokens
    found = sized_join(hits, test, ["s"], "inner", BROADCAST_SEEDS)
    found = found.groupBy("doc_id", "item_id", F.expr("i - ipos").alias("shift"), F.expr(f"i div {REACH}").alias("part")).agg(
        F.min_by(F.struct("lo", F.coalesce("dh", "ih").alias("dh"), "ih"), "i").alias("x")
    )
    # item place j lies on document place j + shift, which is dh[j + shift - lo]
    found = found.select("doc_id", "item_id", "shift", "x.lo", "x.dh", "x.ih")
    first, last = "greatest(0, lo - shift)", "least(size(ih), lo - shift + size(dh))"
    found = settled(found, __same=f"CASE WHEN {last} > {first} THEN transform(sequence({first}, {last} - 1), j -> int(ih[j] = dh[j + shift - lo])) END", __first=first)
    found = settled(found, __w=f"least({OVERLAP}, size(ih))")
    sums = "transform(sequence(0, greatest(size(__same) - __w, 0)), k -> aggregate(slice(__same, k + 1, __w), 0, (a, x) -> a + x))"
    found = settled(found, __best=f"array_max({sums})")
    verified = found.where(f"__best >= CASE WHEN size(ih) < {SPAN} THEN size(ih) ELSE ceil({AGREE} * __w) END")
    return verified.groupBy("doc_id", "item_id").agg(
        F.max(F.expr("aggregate(__same, 0, (a, x) -> a + x)")).alias("matched"), F.min(F.expr(f"CASE WHEN size(ih) >= {SPAN} THEN shift + __first END")).alias("start")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, short: bool = False) -> DataFrame:
    """One row for each contaminated document: ``doc_id, n_items, item_ids, matched`` (most tokens shared with an item)."""
    rows = overlaps(docs, benchmark, short).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("matched").alias("matched"))
    return rows.select("doc_id", F.size("item_ids").cast("long").alias("n_items"), "item_ids", F.col("matched").cast("long").alias("matched"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, short: bool = False) -> DataFrame:
    """The documents that share no passage with the benchmark, all columns as they are."""
    ids = contaminated(docs, benchmark, short).select("doc_id")
    return sized_join(docs, ids, ["doc_id"], "left_anti").select(*docs.columns)


def op1_decontaminate(spark, folder: str) -> DataFrame:
    return contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"), short=True)
