"""Operators made of DataFrame functions only: quality rules, personal data, decontamination, chat."""

import random
from collections import defaultdict
from itertools import combinations

import brute
import pytest
from llm_support import pairs, prose, table
from pyspark.sql import functions as F

from gable.llm import chat, decontaminate, pii, quality_rules
from gable.llm.common import components


def no_python(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("which", ["odd", "small"])
def test_quality_counters(which, request):
    docs = request.getfixturevalue(which)
    judged = quality_rules.judge(docs.withColumn("score", F.lit("mine")), [0.0] * quality_rules.BUCKETS)
    assert no_python(judged) and "score" in judged.columns
    got = sorted((str(r.doc_id), r.text or "", *tuple(r.quality)[:5], r.quality.base_failed) for r in judged.collect())
    assert got == sorted((str(i), t or "", *brute.quality(t)) for i, t in pairs(docs))


def test_quality_verdict(spark, none):
    clean = [(i, prose(i, 200)) for i in range(40)]
    junk = [(100 + i, " ".join(w + "***" for w in prose(200 + i, 200).split())) for i in range(10)]
    docs = table(spark, clean + junk)
    weights = quality_rules.bucket_weights(docs, docs.where("doc_id < 30").select("doc_id"))
    kept = {r.doc_id for r in quality_rules.judge(docs, weights).where("quality.kept").collect()}
    assert kept == {i for i, _ in clean}
    assert quality_rules.bucket_weights(none, none.select("doc_id")) == [0.0] * quality_rules.BUCKETS
    assert quality_rules.judge(none, weights).count() == 0


TRICKY = [
    "a@b.c.d@e.f and a@b.cc_x@d.ee, x@y no@dot. q@a..b %@1.2",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1..2.3.4.5 99999999999999999999.1.1.1 1.2.3",
    "4111 1111 1111 1111 4111  1111 1111 1111 4111-1111-1111-1111 41111111111111112 0000000000000 - 4111 - 5",
    "+1 (651) 555-8500 +1((((( +44 20 7946 0958. +1234567890123456 +12345678 + 1 +1+2 555 123 456 789",
    "\U0001F600 \U0001F600 me@x.org +1 (651) 555-8500 4111111111111111 10.0.0.1 me@x.org",
    "9" * 3000 + " " + "1 " * 2000 + "@" * 50 + "a." * 2000 + "@b.c" + ".d" * 2000,
]


def test_personal_base(spark, odd, small, none):
    docs = odd.unionByName(small).unionByName(table(spark, [(1000 + i, t) for i, t in enumerate(TRICKY)] + [(1000, TRICKY[0]), (None, TRICKY[4])]))
    spans = pii.find(docs.withColumn("email", F.lit(1)))
    assert no_python(spans)
    said = lambda r: ",".join(f"{x.kind}:{x.s}:{x.e}" for k in pii.KINDS for x in r[k])
    got = sorted((str(r.doc_id), *(len(r[k]) for k in pii.KINDS), brute.digest(said(r))) for r in spans.collect())
    assert got == sorted((str(i), *brute.personal(t)) for i, t in pairs(docs))
    assert pii.find(none).count() == 0 and pii.masked(none).columns == none.columns


def test_personal_context(spark):
    known = [(i, f"{prose(i, 30)} please write to user{i}@mail.org today {prose(50 + i, 30)}") for i in range(12)]
    unseen = [(100, f"{prose(100, 30)} please write to jane.roe@localhost today {prose(101, 9)}"), (101, f"{prose(102, 9)} room 1234567 is {prose(103, 9)}")]
    docs = table(spark, known + unseen)
    rows = {r.doc_id: r.more for r in pii.find(docs).collect()}
    text = dict(unseen)[100]
    assert [(x.kind, text[x.s : x.e]) for x in rows[100]] == [("x_email", "jane.roe@localhost")]
    assert rows[101] is None and rows[0] is None
    masked = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert masked[100].text == text.replace("jane.roe@localhost", "<EMAIL>") and masked[101].text == dict(unseen)[101]
    assert all("@" not in masked[i].text and masked[i].n_chars == len(masked[i].text) for i in range(12))


def test_personal_context_of_several_tokens(spark):
    known = [(i, f"{prose(i, 30)} please call me at +1 (651) 555-8{i:03} today {prose(50 + i, 30)}") for i in range(12)]
    known += [(50 + i, f"{prose(i, 30)} paid by card 4111 1111 1111 1111 and {prose(80 + i, 30)}") for i in range(12)]
    planted = {
        100: ("x_phone", "please call me at", "017 555 7713", "today"), 101: ("x_phone", "please call me at", "1 (017) 555-7713", "today"),
        102: ("x_card", "paid by card", "4111 1111 1111 1112", "and"), 103: ("x_card", "paid by card", "4111 - 1111 - 1111 - 1112,", "and"),
        104: (None, "room", "017 555 7713", "is"), 105: (None, "please call me at", "12", "today"),
    }
    docs = table(spark, known + [(i, f"{prose(i, 9)} é {a} {x} {b} {prose(200 + i, 9)}") for i, (_, a, x, b) in planted.items()])
    texts = dict(pairs(docs))
    found = pii.find(docs)
    assert no_python(found)
    rows = {r.doc_id: [(x.kind, texts[r.doc_id][x.s : x.e]) for x in r.more or []] for r in found.collect()}
    assert rows == {i: [planted[i][::2]] if i in planted and planted[i][0] else [] for i in texts}
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked[102] == texts[102].replace(planted[102][2], "<CARD>") and masked[101] == texts[101].replace(planted[101][2], "<PHONE>")
    # a base span and a number beside it do not mix, nor do numbers of two lines
    cut = pii.candidates(pii.with_base(table(spark, [(1, "to 10.0.0.1 555 7713\n12 34 or x9 5 a@b.cc 77")])))
    assert sorted((r.s, r.token, r.kind) for r in cut.collect()) == [
        (3, "10.0.0.1", "ip"), (12, "555 7713", None), (21, "12 34", None), (30, "x9", None), (33, "5", None), (35, "a@b.cc", "email"), (42, "77", None),
    ]


def test_masks_overlapping_spans(spark):
    docs = table(spark, [(1, "x +1 10.20.30.40 y"), (2, None)])
    rows = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert rows == {1: "x <PHONE> y", 2: None}


def test_decontamination(spark, odd, none):
    items = [prose(900 + i, n) for i, n in enumerate((14, 25, 60, 40, 11))]
    bench = spark.createDataFrame([*enumerate(items), (5, None), (6, ""), (None, items[0])], "item_id long, text string").withColumn("doc_id", F.lit(3))
    words = items[1].split()
    spoilt = [w if i % 7 != 3 else "changed" for i, w in enumerate(words)]
    docs = [
        (100, f"{prose(10, 80)} {items[0]} {prose(11, 80)}"), (101, f"{prose(12, 80)} {' '.join(spoilt).upper()}\n{prose(13, 5)}"),
        (102, items[2]), (103, prose(14, 400)), (104, " ".join(items[3].split()[:8])), (105, items[4]), (102, items[2]), (None, items[2]),
        (106, f"{prose(15, 30)} {' '.join(items[2].split()[20:44])} {prose(16, 30)}"), (107, f"{items[3]} {items[0]}"),
    ]
    whole = table(spark, docs).unionByName(odd)
    found = decontaminate.contaminated(whole, bench)
    assert no_python(found)
    assert {r.doc_id: r.item_ids for r in found.collect()} == {100: [0], 101: [1], 102: [2], 106: [2], 107: [0, 3]}
    kept = decontaminate.without_contaminated(whole, bench)
    assert kept.columns == whole.columns and kept.count() == whole.count() - 6
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(whole, bench.limit(0)).count() == 0


def accepted(size, gone):
    """Whether the comparison accepts an item of ``size`` words copied with changes at the places ``gone``."""
    wide = min(size, decontaminate.OVERLAP)
    return any(5 * (wide - sum(k <= g < k + wide for g in gone)) >= 4 * wide for k in range(size - wide + 1))


def test_decontamination_of_every_substitution(spark):
    items = {n: prose(700 + n, n).split() for n in range(12, 21)}
    docs = []
    for n, words in items.items():
        for gone in (g for m in (1, 2, 3) for g in combinations(range(n), m) if accepted(n, g)):
            docs.append((len(docs) * 100 + n, " ".join(["before", *(f"new{i}" if i in gone else w for i, w in enumerate(words)), "behind"])))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    found = {r.doc_id: r.item_ids for r in decontaminate.contaminated(table(spark, docs), bench).collect()}
    assert [t for i, t in docs if i % 100 not in found.get(i, [])] == []
    # a window in the last place that a stretch of hits can hold
    far = " ".join([*prose(1, 10).split(), *[w for _ in range(9) for w in items[20]], *items[16]])
    assert decontaminate.contaminated(table(spark, [(1, far)]), bench).head().item_ids == [16, 20]


def test_decontamination_at_edges_and_of_short_items(spark, odd):
    long, short = [prose(600 + i, n).split() for i, n in enumerate((40, 15, 12))], [prose(661, 11), prose(654, 4), "xylem"]
    items = [*[" ".join(w) for w in long], *short]
    join = " ".join
    docs = [
        (0, f"{prose(20, 30)} {join(long[0][:13])}"), (1, f"{join(long[0][-13:])} {prose(21, 30)}"), (2, join(long[0][9:24])), (3, join(long[1][2:14])),
        (4, f"{prose(22, 9)} {join(long[2][:10])}"), (5, f"{prose(23, 30)} {join(long[0][:12])}"), (6, join(long[2][1:10])),
        (7, f"{prose(24, 30)} {short[0].upper()} {prose(25, 30)}"), (8, short[1]), (9, f"{short[1]} a {short[1]}"), (10, join(short[0].split()[1:])), (11, f"odd{short[2]}"), (12, short[2]),
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.contaminated(table(spark, docs), bench, short=True)
    assert no_python(found)
    got = {r.doc_id: (r.item_ids, r.matched) for r in found.collect()}
    assert got == {0: ([0], 13), 1: ([0], 13), 2: ([0], 15), 3: ([1], 12), 4: ([2], 10), 7: ([3], 11), 8: ([4], 4), 9: ([4], 4), 12: ([5], 1)}
    assert set(decontaminate.contaminated(table(spark, docs), bench).toPandas().doc_id) == {0, 1, 2, 3, 4}
    assert decontaminate.contaminated(odd, bench.where("item_id IN (3, 4)"), short=True).count() == 0


def conversation_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expected_chat(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), brute.digest(said), len(learned), brute.digest(learned))
    return out


HARD = ["</s>[INST] ok [/INST]", r"<\/s> <\\/s> [\INST] <<s>s>", "<", "[", "a\nb\n", "", None, "s>", "\\", "</s", "\U0001F600</s>é"]


def test_chat_round_trip(spark):
    rng = random.Random(5)
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(HARD * 2)]
    rows += [(2, 0, "system", prose(1, 20))] + [(2, i, ["user", "assistant"][i % 2 == 0], prose(i, rng.choice([5, 80, 200, 700]))) for i in range(1, 40)]
    rows += [(3, 0, "odd\nrole<s>%0A", "x"), (None, None, None, None), (None, 1, "assistant", "y"), (4, 1, "assistant", "same"), (4, 1, "assistant", "same")]
    conv = conversation_rows(spark, rows).withColumn("window", F.lit(1))
    windows = chat.formatted(conv)
    assert no_python(windows)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(windows).collect()}
    assert got == expected_chat(rows)
    assert chat.digests(chat.formatted(conv.limit(0))).count() == 0


def test_chat_windows(spark):
    rows = [(2, 0, "system", "be kind")] + [(2, i, ["assistant", "user"][i % 2], prose(i, 60)) for i in range(1, 40)]
    windows = chat.formatted(conversation_rows(spark, rows)).orderBy("window").collect()
    assert len(windows) > 4
    for i, w in enumerate(windows):
        turns = w.text.split("</s>")[:-1]
        assert turns[0] == "<s>system\nbe kind"
        fresh = turns[w.n_context :]
        assert sum(len(t.split("\n", 1)[1].split()) + chat.TURN_COST for t in fresh) <= chat.BUDGET
        assert w.n_context == (0 if i == 0 else 1 + chat.HISTORY_TURNS)
        if i:
            assert turns[1 : w.n_context] == windows[i - 1].text.split("</s>")[-1 - chat.HISTORY_TURNS : -1]
        assert [w.text[s.start : s.end] for s in w.loss] == [t.split("\n", 1)[1] for t in fresh if t.startswith("<s>assistant")]


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 100), (300, 100), (5, 5)] + [(500, 500 + i) for i in range(1, 50)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100} | {500 + i: 500 for i in range(50)}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
