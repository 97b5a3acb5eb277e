"""Personal data: four base patterns, and contextual patterns bootstrapped from what they find.

Base spans are leftmost non-overlapping matches per kind, checked afterwards (parts
of an address, digit count, check digit). They are the seeds of a bootstrap: every
token that looks like an identifier is an instance, and so is every longest run of
tokens of digits that only spaces, brackets, dots and hyphens join, outside base spans
(a base span over several tokens is one instance too). The words around it are its
lexical patterns (the two words before it; the word before and the word after it).
Instances and patterns form a graph that Spark scores in rounds: a pattern is worth
the mean confidence of its instances in a kind, damped by ``DAMPING`` so that few
sightings prove little; an instance that is no seed takes the best of its patterns.
Instances that a pattern of at least ``TRUST`` marks are reported as ``x_<kind>``.

Everything is DataFrame functions. The regular expressions below are forms of the
stated ones that never backtrack over a long run: a match may start only where a run
starts or the last match ended, and runs are possessive; doubled separators are
replaced by a character of the same length before cards are looked for.

Defined cases: a null or empty text has no spans; a row is identified by ``doc_id``
and its text, so rows that repeat both get the same spans, and rows that share a null
or equal ``doc_id`` but not the text do not mix; empty tables give empty results;
``find`` ignores other columns, ``masked`` passes them through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gable.llm.common import BLANKS, read, settled, sized_join
from gable.runtime import stage

#: Kinds in order, and the text that replaces each in a masked document.
KINDS = ("email", "ip", "card", "phone")
MASKED = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": "[0-9][0-9 -]*[0-9]",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap test that a text may hold the kind at all.
MAY_HOLD = {"email": "contains(__t, '@')", "ip": "__digit", "card": "__digit", "phone": "__digit AND contains(__t, '+')"}
_BYTE = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
VALID = {
    "email": "true",
    "ip": rf"m rlike r'^{_BYTE}(?:\.{_BYTE}){{3}}$'",
    "card": "length(translate(m, ' -', '')) BETWEEN 13 AND 19 AND luhn_check(translate(m, ' -', ''))",
    "phone": "length(translate(m, '+ ().-', '')) BETWEEN 9 AND 15",
}
#: Tokens that look like identifiers.
TOKEN = r"(?<![^ \t\n\x0B\f\r])[^ \t\n\x0B\f\r0-9@]*+[0-9@][^ \t\n\x0B\f\r]*+"
#: Tokens that a run may go on after, tokens that may go on with it, and what lies between.
GOES_ON, FOLLOWS = r"^[^\p{L}\p{N}@+().-]*+[0-9+().-]++$", r"^[0-9+().-]++[^\p{L}\p{N}@+().-]*+$"
JOINT = r"^[ ().-]++$"
#: Rounds of the bootstrap, damping of pattern scores, least score of a trusted pattern.
ROUNDS, DAMPING, TRUST = 3, 3.0, 0.5
#: Least digits of an unseen identifier that has no @, and least length.
LEAST_DIGITS, LEAST_LENGTH = 3, 5
#: Matches in a block of the running sums.
BLOCK = 256


def starts_of(lengths: str) -> str:
    """SQL: running sums before each element of an array of longs, in blocks so that long arrays stay cheap."""
    blocks = f"transform(sequence(0, (size({lengths}) - 1) div {BLOCK}), c -> slice({lengths}, c * {BLOCK} + 1, {BLOCK}))"
    carry = f"aggregate({blocks}, array(0L), (a, b) -> concat(a, array(element_at(a, -1) + aggregate(b, 0L, (s, x) -> s + x))))"
    inner = "aggregate(b, array(o[c]), (a, x) -> concat(a, array(element_at(a, -1) + x)))"
    return (
        f"CASE WHEN size({lengths}) = 0 THEN array() ELSE"
        f" flatten(transform(array({carry}), o -> flatten(transform({blocks}, (b, c) -> slice({inner}, 1, size(b)))))) END"
    )


def with_matches(docs: DataFrame, kind: str, pattern: str, text: str, may: str) -> DataFrame:
    """Adds ``__<kind>``: array of ``s, e, m`` (start, end, matched text) of all matches, in order."""
    empty = "cast(array() AS array<string>)"
    cut = settled(
        docs,
        __gaps=f"CASE WHEN {may} THEN split({text}, r'{pattern}') ELSE {empty} END",
        __found=f"CASE WHEN {may} THEN regexp_extract_all({text}, r'{pattern}', 0) ELSE {empty} END",
    )
    sums = settled(cut, __len="transform(__found, (m, i) -> cast(length(__gaps[i]) + length(m) AS bigint))")
    begun = settled(sums, __from=starts_of("__len"))
    each = "struct(__from[i] + length(__gaps[i]) AS s, __from[i] + length(__gaps[i]) + length(m) AS e, m AS m)"
    return settled(begun, **{f"__{kind}": f"transform(__found, (m, i) -> {each})"}).drop("__gaps", "__found", "__len", "__from")


def with_base(docs: DataFrame) -> DataFrame:
    """Adds ``__t`` (the text, null as empty), ``__digit`` and an array of checked spans for each kind."""
    rows = settled(docs, __t=F.coalesce(F.col("text"), F.lit("")))
    rows = settled(rows, __digit="__t rlike '[0-9]'")
    single = r"CASE WHEN __digit THEN regexp_replace(__t, '(?<=[ -])[ -]|[ -](?=[ -])', '\u0001') ELSE '' END"
    rows = settled(rows, __one=single)
    for kind in KINDS:
        rows = with_matches(rows, kind, PATTERNS[kind], "__one" if kind == "card" else "__t", MAY_HOLD[kind])
        rows = settled(rows.withColumnRenamed(f"__{kind}", "__all"), **{f"__{kind}": f"filter(__all, x -> {VALID[kind].replace('m ', 'x.m ').replace('(m,', '(x.m,')})"}).drop("__all")
    return rows.drop("__one")


def with_runs(rows: DataFrame) -> DataFrame:
    """Adds ``__runs``: ``s, e, m, kind`` of each token or run of neighbouring tokens, in order."""
    spans = ", ".join(f"transform(__{k}, y -> struct('{k}' AS kind, y.s AS s, y.e AS e))" for k in KINDS)
    rows = settled(rows, __spans=f"concat({spans})")
    seed = "get(filter(__spans, y -> y.s < x.e AND x.s < y.e), 0)"
    rows = settled(rows, __seen=f"transform(__tokens, x -> struct(x.s AS s, x.e AS e, x.m AS m, {seed} AS seed, x.m rlike r'{GOES_ON}' AS left, x.m rlike r'{FOLLOWS}' AS right))")
    last = "__seen[i - 1]"
    between = f"substring(__t, cast({last}.e AS int) + 1, cast(x.s - {last}.e AS int))"
    joined = (
        f"CASE WHEN i = 0 THEN false WHEN x.seed IS NOT NULL OR {last}.seed IS NOT NULL THEN coalesce(x.seed = {last}.seed, false)"
        f" ELSE {last}.left AND x.right AND {between} rlike r'{JOINT}' END"
    )
    rows = settled(rows, __begin=f"array_compact(transform(__seen, (x, i) -> CASE WHEN NOT ({joined}) THEN i END))")
    rows = settled(rows, __ends="transform(__begin, (p, k) -> struct(p AS p, coalesce(get(__begin, k + 1), size(__seen)) - 1 AS q))")
    whole = "CASE WHEN x.p = x.q THEN __seen[x.p].m ELSE substring(__t, cast(__seen[x.p].s AS int) + 1, cast(__seen[x.q].e - __seen[x.p].s AS int)) END"
    return settled(rows, __runs=f"transform(__ends, x -> struct(__seen[x.p].s AS s, __seen[x.q].e AS e, {whole} AS m, __seen[x.p].seed.kind AS kind))")


def candidates(based: DataFrame) -> DataFrame:
    """One row for each identifier-like token or run: ``doc_id, key, s, e, token, kind, patterns``; ``kind`` is that of the seed it overlaps."""
    rows = with_runs(with_matches(based, "tokens", TOKEN, "__t", "__digit OR contains(__t, '@')"))
    blanks = "'" + "".join(f"\\u{ord(c):04x}" for c in BLANKS) + "'"
    gap = rf"trim(translate(substring(__t, greatest(x.s - 64, 0) + 1, least(x.s, 64)), {blanks}, '      '))"
    after = rf"trim(translate(substring(__t, x.e + 1, 64), {blanks}, '      '))"
    each = f"struct(x.s AS s, x.e AS e, x.m AS token, x.kind AS kind, lower({gap}) AS before, lower({after}) AS behind)"
    rows = settled(rows, __c=f"transform(__runs, x -> {each})")
    flat = rows.select("doc_id", F.expr("xxhash64(__t)").alias("key"), F.explode_outer("__c").alias("x")).where("x IS NOT NULL")
    two, one = "substring_index(x.before, ' ', -2)", "substring_index(x.before, ' ', -1)"
    follow = "substring_index(x.behind, ' ', 1)"
    patterns = f"filter(array(concat('L ', {two}), concat('B ', {one}, ' _ ', {follow})), p -> length(p) > 6)"
    return flat.select("doc_id", "key", "x.s", "x.e", "x.token", "x.kind", F.expr(patterns).alias("patterns"))


def bootstrap(instances: DataFrame) -> DataFrame:
    """``doc_id, key, s, e, kind``: identifiers that no base pattern matches and a trusted context marks."""
    rows = stage(instances, "instances")
    edges = rows.select("token", "kind", F.explode("patterns").alias("pattern"))
    # sightings of a token in a context, counted once; a seed keeps confidence 1
    graph = stage(edges.groupBy("pattern", "token").agg(F.min("kind").alias("kind"), F.count(F.lit(1)).alias("n")), "graph")
    known = graph.where("kind IS NOT NULL").select("pattern", "token", "kind", F.lit(1.0).alias("conf"), "n")
    totals = graph.groupBy("pattern").agg(F.sum("n").alias("total"))
    scores = None
    for _ in range(ROUNDS):
        sums = known.groupBy("pattern", "kind").agg(F.sum(F.expr("conf * n")).alias("mass"))
        scores = stage(sums.join(totals, "pattern").select("pattern", "kind", F.expr(f"mass / (total + {DAMPING})").alias("score")), "scores")
        open_ = graph.where("kind IS NULL").select("pattern", "token", "n")
        best = sized_join(open_, scores.where("score > 0.05"), ["pattern"], "inner")
        conf = best.groupBy("token", "kind").agg(F.max("score").alias("conf"))
        induced = sized_join(open_, conf, ["token"], "inner").select("pattern", "token", "kind", "conf", "n")
        seeds = graph.where("kind IS NOT NULL").select("pattern", "token", "kind", F.lit(1.0).alias("conf"), "n")
        known = seeds.union(induced)
    trusted = scores.where(f"score >= {TRUST}").select("pattern", F.col("kind").alias("found"), "score")
    digits = "length(regexp_replace(token, '[^0-9]', ''))"
    unseen = rows.where(f"kind IS NULL AND length(token) >= {LEAST_LENGTH} AND (contains(token, '@') OR {digits} >= {LEAST_DIGITS})")
    hits = sized_join(unseen.select("doc_id", "key", "s", "e", F.explode("patterns").alias("pattern")), trusted, ["pattern"], "inner")
    best = hits.groupBy("doc_id", "key", "s", "e").agg(F.max(F.struct("score", "found")).alias("b"))
    return best.select("doc_id", "key", "s", "e", F.expr("concat('x_', b.found)").alias("kind"))


def discovered(docs: DataFrame) -> DataFrame:
    """Contextual spans of all documents, an array for each ``doc_id, key`` that has any."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = bootstrap(candidates(with_base(rows)))
    return found.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("kind", "s", "e"))).alias("more"))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, email, ip, card, phone, more``: arrays of spans for each row of ``docs``."""
    rows = with_base(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    spans = rows.select("doc_id", F.expr("xxhash64(__t)").alias("key"), *[F.expr(f"transform(__{k}, x -> struct('{k}' AS kind, x.s AS s, x.e AS e))").alias(k) for k in KINDS])
    more = discovered(docs).withColumnsRenamed({"doc_id": "__id", "key": "__key"})
    side = stage(more, "more")
    return spans.join(side, F.expr("doc_id <=> __id AND key = __key"), "left").drop("__id", "__key", "key")


def digest_text(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')"


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by the mark of its kind; ``n_chars``, if there, is that of the new text."""
    more = stage(discovered(docs).withColumnsRenamed({"doc_id": "__id", "key": "__key", "more": "__more"}), "more")
    rows = settled(with_base(docs), __k="xxhash64(__t)")
    joined = rows.join(more, F.expr("doc_id <=> __id AND __k = __key"), "left")
    marks = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MASKED.items())
    parts = ", ".join(f"transform(__{k}, x -> struct(x.s AS s, x.e AS e, '{MASKED[k]}' AS mark))" for k in KINDS)
    found = f"transform(coalesce(__more, array()), x -> struct(cast(x.s AS bigint) AS s, cast(x.e AS bigint) AS e, CASE substring(x.kind, 3) {marks} END AS mark))"
    cuts = settled(joined, __cuts=f"array_sort(concat({parts}, {found}))")
    # overlapping spans become one run with the mark of the first
    runs = (
        "aggregate(__cuts, cast(array() AS array<struct<s: bigint, e: bigint, mark: string>>), (a, x) ->"
        " CASE WHEN size(a) > 0 AND x.s < element_at(a, -1).e"
        " THEN concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).s AS s, greatest(element_at(a, -1).e, x.e) AS e, element_at(a, -1).mark AS mark)))"
        " ELSE concat(a, array(x)) END)"
    )
    cuts = settled(cuts, __runs=f"CASE WHEN size(__cuts) > 0 THEN {runs} END")
    piece = "concat(substring(__t, cast(CASE WHEN i = 0 THEN 0 ELSE __runs[i - 1].e END AS int) + 1, cast(x.s - CASE WHEN i = 0 THEN 0 ELSE __runs[i - 1].e END AS int)), x.mark)"
    tail = "substring(__t, cast(element_at(__runs, -1).e AS int) + 1)"
    done = settled(cuts, __new=f"CASE WHEN size(__cuts) > 0 THEN concat(array_join(transform(__runs, (x, i) -> {piece}), ''), {tail}) ELSE text END")
    replaced = {"text": F.col("__new")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        replaced["n_chars"] = F.expr("CASE WHEN size(__cuts) > 0 THEN length(__new) ELSE n_chars END").cast(kind)
    return done.withColumns(replaced).select(*docs.columns)


def op3_pii(spark, folder: str) -> DataFrame:
    spans = find(read(spark, folder, "documents"))
    base = settled(spans, base="concat(email, ip, card, phone)", extra="coalesce(more, cast(array() AS array<struct<kind: string, s: bigint, e: bigint>>))")
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return base.select(
        "doc_id",
        *counts,
        F.expr(f"sha2({digest_text('base')}, 256)").alias("base_sha256"),
        F.expr(digest_text("concat(base, extra)")).alias("spans"),
        F.size("extra").cast("long").alias("n_context"),
    )
