"""Operators for training data: against brute force, exact round trips, and edge cases."""

import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import binpack, leaks, lexicon, minhash, mixing, pairs, quality, queries, stuffing

WORD = re.compile(r"[^\W_]+")
PROSE = "The old engineer opened the gate and walked to the river. It was late in the year, and nobody was there. A small boat lay on the water near the bridge."


def test_queries_are_registered():
    q = queries.queries()
    assert {f"p{i}_found" for i in range(1, 8)} <= set(q) and set(queries.oracle_sql()) <= set(q)


# 1


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (None, "short"), ("", "short"), (" \n\t ", "short"), ("Yes.", "short"), ("the red boat", "short"), (PROSE, "prose"), (PROSE.replace(" ", "\n", 9), "prose"),
        (PROSE + "\n- a boat\n- the gate\n" + PROSE, "prose"), ("\n".join(f"- item {c}" for c in "abcdefgh"), "list"), ("\n".join(f"{i}. thing number {i}" for i in range(9)), "list"),
        ("a,b,c\n" * 6, "table"), ("| a | b |\n|---|---|\n| c | d |\n| e | f |", "table"), ("name      size    place\nboat      12      river\ngate      7       town\nbridge    90      hill", "table"),
        ("6a 37 e8 14 96 16 d0 b6 1f 26 65 9b 5a da 03 b1", "junk"), ("boat " * 40, "junk"), ("xqv zzkj wqpf plkmn vbxz qwrt zxcv mnbv lkjh", "junk"), ("~*~*~*~*~*~*~*~*\n=-=-=-=-=-=-=-\n_._._._._._.", "junk"), ("x" * 100_000, "junk"),
        ("A" * 60 + "/" + "b9" * 80 + "==", "junk"), ("The motor monitors the pulley above the tutor.", "prose"),
    ],
)
def test_kinds(text, kind):
    assert quality.describe(text)[-1] == kind


def test_periodic_layouts():
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choices("the old boat and a gate near the river with nobody on it was there in town".split(), k=n))
    indented = "\n".join(("" if i % 3 == 0 else "    ") + say(rng.randint(13, 22)) for i in range(18))
    lengths = "\n".join(say((24, 13, 13)[i % 3]) for i in range(18))
    turns = "\n".join(f"record {i} of the {say(22)}\n{say(2)} | {say(2)} | {i} | {say(3)} | {say(2)} | {say(3)}" for i in range(8))
    for text, kind, periodic in ((indented, "list", (True, False)), (lengths, "list", (False, True)), (turns, "table", (False, True))):
        got = dict(zip([n for n, _ in quality.STATS], quality.describe(text), strict=True))
        assert (got["kind"], (got["indent_period"] >= 0.5, got["line_autocorr"] >= 0.6)) == (kind, periodic)
    # no period, sentences in a layout, lines that end as sentences
    assert quality.describe("\n".join(say(n) for n in (15, 21, 13, 18, 25, 14, 16, 22)))[-1] == "prose"
    assert quality.describe("\n".join(("    " if i % 3 == 0 else "") + x for i, x in enumerate((PROSE + " " + PROSE).replace(", ", ",\n").replace(". ", ".\n").split("\n") * 3)))[-1] == "prose"


def test_gibberish_on_several_lines():
    rng = random.Random(6)
    noise = lambda k: " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(3, 7))) for _ in range(k))
    coded = lambda k: " ".join(f"{rng.randrange(65536):04x}" for _ in range(k))
    for make in (noise, coded):
        for lines, words in ((1, 20), (3, 6), (3, 20), (8, 4), (8, 20)):
            assert quality.describe("\n".join(make(words) for _ in range(lines)))[-1] == "junk"
    blob = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=76 * 6))
    assert quality.describe("\n".join(blob[i : i + 76] for i in range(0, len(blob), 76)))[-1] == "junk"
    assert quality.describe("\n".join("boat gate river town " * 5 for _ in range(3)))[-1] == "junk"
    # lists of names and of numbers have no common words either
    assert quality.describe("Berlin\nParis\nMadrid\nLondon\nWien\nBern\nRom\nOslo\nStockholm\nAmsterdam")[-1] == "list"
    assert quality.describe("\n".join(str(x * x) for x in range(100, 112)))[-1] == "list"
    assert quality.describe(PROSE.replace(" ", "\n"))[-1] == "prose"


def test_answers():
    assert quality.answer_of("### Instruction:\nq\n\n### Response:\na\nb", "alpaca") == "a\nb"
    assert quality.answer_of("<|im_start|>user\nq\n<|im_end|>\n<|im_start|>assistant\na\n<|im_end|>", None) == "a\n"
    assert quality.answer_of("Human: q\n\nAssistant: a", "unknown") == "a"
    assert quality.answer_of("plain", "chatml") == "plain" and quality.answer_of(None, "chat") is None


def test_statistics_frame(spark):
    d = spark.createDataFrame([(1, PROSE, "x"), (1, PROSE, "x"), (2, None, None)], "kind int, text string, n_words string")
    got = quality.text_statistics(d).collect()
    assert len(got) == 3 and {r["_kind"] for r in got} == {"prose", "short"} and got[0]["_n_words"] in (len(WORD.findall(PROSE)), 0) and {r["n_words"] for r in got} == {"x", None}
    assert quality.text_statistics(d.limit(0)).count() == 0


def test_long_texts_take_time_in_proportion():
    n = 60_000
    index = leaks.indexes(leaks.targets([(1, PROSE, "where is the boat")], leaks.Settings()))
    for t in ("a" * n, "a." * n, "a://" + "a" * n, "<" * n + " www.a", "<a " * n, "#" * n, "-a" * n + "://x", "x\n" * n, "- x y\n" * (n // 4), " " * n, ". " * n, "`" * n, "\U0001f600" * n, "a@b.co " * (n // 4), "“" * n, "a|b|c\n" * (n // 4)):
        began = time.process_time()
        stuffing.measure(t), quality.describe(t), pairs.defect(t, t), [list(leaks.scan([t], i)) for i in index]
        assert time.process_time() - began < 5


def test_portions():
    texts = ["a" * n for n in (3, 4, 20, 1, 1, 1, 9)] + [None, ""]
    got = list(lexicon.portions(texts, 10, 3))
    assert got == [(0, 2), (2, 3), (3, 6), (6, 9)] and list(lexicon.portions([])) == [] and list(lexicon.portions([None])) == [(0, 1)]


# 2


def jaccard_pairs(texts, k, t, least):
    sets = {}
    for i, s in texts.items():
        w = WORD.findall((s or "").lower())
        if len(w) >= max(k, least):
            sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}


def test_near_duplicates(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, n = {}, 0
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.randint(15, 80))
        for _ in range(rng.randint(1, 4)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts[n] = " ".join(w)
            n += 1
    texts.update({n: None, n + 1: "", n + 2: "few words", n + 3: texts[0], n + 4: texts[0].upper() + "!"})
    rows = [(i, t) for i, t in texts.items()] + [(0, texts[0])]  # delivered twice
    d = spark.createDataFrame(rows, "i bigint, t string").repartition(4)
    s = minhash.Settings(k=3, threshold=0.7, bands=26, rows=4, min_words=20)
    groups = minhash.near_duplicates(d, "i", F.col("t"), s)
    expected = jaccard_pairs(texts, 3, 0.7, 20)
    assert {tuple(r) for r in minhash.duplicate_pairs(groups).collect()} == expected
    # by prefixes alone the same comes out
    crowded = minhash.near_duplicates(d, "i", F.col("t"), minhash.Settings(k=3, threshold=0.7, bands=26, rows=4, min_words=20, bucket=1))
    assert {tuple(r) for r in minhash.duplicate_pairs(crowded).collect()} == expected
    reps = {tuple(r)[:2] for r in minhash.class_pairs(groups).collect()}
    assert reps <= expected and all(a < b for a, b in reps)
    g = {r.record: r for r in minhash.duplicate_groups(groups).collect()}
    assert g[n + 3].rep == g[n + 4].rep == g[0].rep and g[0].copies >= 3 and n not in g and n + 2 not in g
    empty = minhash.near_duplicates(d.limit(0), "i", F.col("t"), s)
    assert minhash.duplicate_pairs(empty).count() == 0 and minhash.duplicate_groups(empty).count() == 0


def test_pairs_of_a_large_class(spark):
    words = " ".join(f"w{i}" for i in range(30))
    variants = [words, words.upper(), words.replace(" ", ",\n"), words + "!"]
    rows = [(i, variants[i % 4]) for i in range(1100)] + [(2000 + i, words + " more") for i in range(3)]
    d = spark.createDataFrame(rows, "i bigint, t string").repartition(4)
    groups = minhash.near_duplicates(d, "i", F.col("t"), minhash.Settings(k=3, threshold=0.7, bands=26, rows=4, min_words=20))
    ids = sorted(i for i, _ in rows)
    for block in (1000, 300):
        got = minhash.duplicate_pairs(groups, block=block).toPandas()
        assert len(got) == math.comb(len(ids), 2) == len(got.drop_duplicates()) and (got.record_a < got.record_b).all() and set(got.record_a) | set(got.record_b) == set(ids)


def test_pairs_in_blocks(spark):
    # 9 is in two classes, which are linked to each other and to a third
    members = [(i, c, 0) for c, of in {1: range(5), 2: range(5, 10), 3: [9, 20, 21], 4: [30], 5: range(40, 47)}.items() for i in of]
    links = [(1, 2, 0.9), (2, 3, 0.8), (3, 4, 0.8)]
    groups = minhash.Groups(spark.createDataFrame(members, "record bigint, class bigint, check bigint"), spark.createDataFrame(links, "class_a bigint, class_b bigint, similarity double"))
    linked = {(a, b) for a, b, _ in links}
    expected = {(a, b) for a, c, _ in members for b, e, _ in members if a < b and (c == e or (c, e) in linked or (e, c) in linked)}
    for block in (1, 2, 3, 1000):
        got = [tuple(r) for r in minhash.duplicate_pairs(groups, block=block).collect()]
        assert len(got) == len(expected) and set(got) == expected


def test_probminhash_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 2**63, 200, dtype=np.uint64), rng.integers(1, 2**63, 100, dtype=np.uint64)
    both = np.concatenate([a[:150], b])  # 150 shared of 200 and 250
    row = np.repeat([0, 1], [200, 250])
    sig = minhash.probminhash(row, np.concatenate([a, both]), np.ones(450), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - 150 / 300) < 0.03
    # weights: elements {x: 3, y: 1} and {x: 1, y: 1}: sum over shared of 1 / sum of max of ratios
    x, y = a[:2]
    sig = minhash.probminhash(np.array([0, 0, 1, 1]), np.array([x, y, x, y]), np.array([3.0, 1.0, 1.0, 1.0]), 2, 8192)
    assert abs((sig[0] == sig[1]).mean() - (1 / (1 + 1) + 1 / (3 + 1))) < 0.03
    assert abs((sig[0] == x).mean() - 0.75) < 0.03


def probability_jaccard(x, y):
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)


def test_weighted_near_duplicates(spark):
    rng = random.Random(8)
    for _ in range(50):
        x, y = ({i: rng.randint(1, 4) for i in rng.sample(range(12), rng.randint(1, 10))} for _ in range(2))
        arrays = [np.array(v) for d in (x, y) for v in (sorted(d), [d[k] for k in sorted(d)])]
        assert abs(minhash.probability_jaccard(*arrays) - probability_jaccard(x, y)) < 1e-9
    # boilerplate in all, words repeated more or less often: sets alone would link too much
    boiler, texts = " ".join(f"b{i}" for i in range(15)), {}
    for n in range(120):
        own = [f"o{n // 4}x{i}" for i in range(rng.randint(5, 12))]
        texts[n] = " ".join([boiler, *own, *own * rng.choice([0, 0, 1, 3])])
    weights = {}
    for i, t in texts.items():
        w = t.split()
        weights[i] = {}
        for j in range(len(w) - 1):
            weights[i][tuple(w[j : j + 2])] = weights[i].get(tuple(w[j : j + 2]), 0) + 1
    least = {}
    for i in sorted(weights):
        least.setdefault(tuple(sorted(weights[i].items())), i)
    expected = {(a, b) for a, b in itertools.combinations(sorted(least.values()), 2) if probability_jaccard(weights[a], weights[b]) >= 0.8}
    d = spark.createDataFrame(list(texts.items()), "i bigint, t string").repartition(4)
    for bucket in (1000, 5):
        groups = minhash.near_duplicates(d, "i", F.col("t"), minhash.Settings(k=2, weights="count", bucket=bucket))
        assert {tuple(r)[:2] for r in minhash.class_pairs(groups).collect()} == expected
    assert expected


# 3


def test_best_fit():
    rng = random.Random(3)
    for open_bins in (1, 2, 8, 1000):
        p, held = binpack.BestFit(20, open_bins), {}
        for _ in range(500):
            n = rng.randint(1, 20)
            b, at = p.place(n)
            held.setdefault(b, []).append((at, n))
            assert p.in_use <= open_bins and p.in_use == sum(map(len, p.bins.values()))
        for items in held.values():
            assert [at for at, _ in sorted(items)] == [sum(n for _, n in sorted(items)[:i]) for i in range(len(items))] and sum(n for _, n in items) <= 20
    p = binpack.BestFit(10, 2)
    assert [p.place(n) for n in (7, 6, 4, 3)] == [(0, 0), (1, 0), (1, 6), (0, 7)]  # best fit, not first
    p = binpack.BestFit(10, 2)
    assert [p.place(n)[0] for n in (8, 5, 9, 2, 5)] == [0, 1, 2, 1, 3]  # the fullest (bin 0) was closed for bin 2, and bin 2 for bin 3
    assert binpack.BestFit(10, 2).pieces(25) == [(0, 0, 10), (1, 0, 10), (2, 0, 5)] and binpack.BestFit(10, 2).pieces(0) == []


def test_pack_frame(spark):
    rows = [("s", i, (i * 7) % 23, 16) for i in range(200)] + [(None, 1, 3, 16), ("s", 500, None, 16), ("t", 1, 5, 8)]
    d = spark.createDataFrame(rows, "stream string, bin int, n int, cap int")
    got = binpack.pack(d, "stream", ["bin"], "n", "cap", items_per_shard=70, open_bins=4).collect()
    assert {r.shard for r in got} == {0, 1, 2}
    fill: dict = {}
    for r in got:
        fill[r.stream, r.shard, r["_bin"]] = fill.get((r.stream, r.shard, r["_bin"]), 0) + r.size
        assert (r.pieces > 1) == ((r["bin"] * 7) % 23 > 16 and r.stream == "s")
    assert max(fill.values()) <= 16 and sum(fill.values()) == sum(n for s, _, n, _ in rows if s and n)
    assert binpack.pack(d.limit(0), "stream", ["bin"], "n", "cap").count() == 0


def test_fill(spark):
    rng = random.Random(14)
    rows = [(s, i, min(3000, int(60 * math.exp(rng.gauss(1, 0.8)))), 2048) for s, n in (("large", 12_000), ("small", 600)) for i in range(n)]
    d = spark.createDataFrame(rows, "stream string, i int, n int, cap int")
    packed = binpack.pack(d, "stream", ["i"], "n", "cap", items_per_shard=4000)
    got = {r.stream: r for r in binpack.fill(packed, "stream", spark.createDataFrame([("large", 2048), ("small", 2048)], "stream string, capacity int")).collect()}
    assert (got["large"].shards, got["small"].shards) == (3, 1) and all(r.within_bound and r.fill > 0.96 for r in got.values())
    assert {s: r.items_cut for s, r in got.items()} == {s: sum(n > 2048 for t, _, n, _ in rows if t == s) for s in got}


def test_needless_cuts(spark):
    runs = spark.createDataFrame([(1, 8, 1, 2, 0), (2, 8, 1, 2, 2)], "run_id bigint, sequence_length int, bos_id int, eos_id int, pad_id int")
    rows = [
        (10, 1, 0, [1, 9, 9, 2, 1, 9, 9, 0]), (11, 1, 1, [9, 9, 2, 0, 0, 0, 0, 0]),  # cut needlessly, with padding between
        (12, 1, 2, [1, 9, 9, 9, 9, 9, 9, 9]), (13, 1, 3, [9, 9, 9, 2, 1, 9, 2, 0]),  # too long for a row
        (14, 1, 4, [1, 9, 9, 0, 0, 0, 0, 0]), (15, 1, 5, [1, 9, 2, 0, 0, 0, 0, 0]),  # cut off with no continuation
        (16, 1, 6, [1, 9, 0, 0, 0, 0, 0, 0]), (17, 1, 7, [9, 0, 0, 0, 0, 0, 0, 0]), (18, 1, 8, [9, 2, 0, 0, 0, 0, 0, 0]),  # over three rows
        (19, 1, 10, [9, 2, 0, 0, 0, 0, 0, 0]), (20, 1, 11, None), (21, None, 1, [1, 9]), (22, 9, 0, [1, 2]), (23, 1, 12, []),
        (30, 2, 0, [1, 9, 9, 9, 9, 9, 1, 9]), (31, 2, 1, [9, 2, 2, 2, 2, 2, 2, 2]),  # padding is the end token
    ]
    d = spark.createDataFrame(rows + rows[:2], "example_id bigint, run_id bigint, seq_no int, input_ids array<int>")
    assert sorted(r.example_id for r in binpack.needless_cuts(d, runs).collect()) == [10, 11, 16, 17, 18, 30, 31]
    assert binpack.needless_cuts(d.limit(0), runs).count() == 0


# 4


@pytest.mark.parametrize(
    ("prompt", "response", "defect"),
    [
        ("Why?", None, "empty"), ("Why?", "\u200b \n", "empty"), ("Why?", "[N/A]", "empty"), ("Why?", "<|im_end|>", "empty"), ("Why?", "...", "empty"), (None, None, "empty"), ("Why?", "No.", None), ("Why?", "the red boat", None), (None, PROSE, None),
        ("What is the old boat by the river made of?", "WHAT IS THE OLD BOAT BY THE RIVER MADE OF", "copy"), ("What is the old boat by the river made of?", "Question: What is the old boat by the river made of?", "copy"),
        ("What is the old boat by the river made of?", "What is the old boat by the river made of? " + PROSE, None),
        ("Tell me about boats.", "I'm sorry, but I can't help with boats. Please ask something else.", "refusal"), ("Tell me about boats.", "Unfortunately, there is more than one way. " + PROSE, None), ("Cuéntame.", "Lo siento, pero no puedo ayudarte con el barco.", "refusal"),
        ("Tell me about boats.", "I can't help with the red boat. " + PROSE, None), ("Tell me about the boats.", "Der alte Mann ist nicht zu Hause und die Frau wartet auf das Boot.", "language"),
        ("Tell me about the boats. (reply in German)", "Der alte Mann ist nicht zu Hause und die Frau wartet auf das Boot.", None), ("Tell me about boats.", PROSE[:-30], "truncated"), ("Tell me about boats.", PROSE + " (and the boat", "truncated"),
        ("Tell me about boats.", PROSE + "\n- a boat\n- the gate", None), ("List boats.", "\n".join(f"- boat {c}" for c in "abcdefgh"), None), ("Tell me about boats.", PROSE + " “It was late.”", None), ("Run it.", "The loop is this:\n```\nfor k in range(9):\n    step(", "truncated"),
    ],
)
def test_defects(prompt, response, defect):
    assert pairs.defect(prompt, response) == defect


def test_suffix_automaton():
    rng = random.Random(5)
    for _ in range(60):
        a, b = ([rng.choice("xyz") for _ in range(rng.randint(0, 12))] for _ in range(2))
        for length, i, j in pairs.SuffixAutomaton(a).matches(b):
            best = max(n for n in range(i + 2) if any(a[s : s + n] == b[i - n + 1 : i + 1] for s in range(len(a) - n + 1)))
            assert length == best and (not length or a[j - length + 1 : j + 1] == b[i - length + 1 : i + 1])


def test_pair_frame(spark):
    d = spark.createDataFrame([("p", None, "x"), ("p", "Yes.", None)], "prompt string, response string, defect string")
    assert [(r.defect, r["_defect"]) for r in pairs.pair_defects(d).collect()] == [("x", "empty"), (None, None)] and pairs.pair_defects(d.limit(0)).count() == 0


def test_long_refusals():
    declining = " ".join(f"I'm sorry, but I can't help with the {w} boat or with the gate." for w in "red old new big low far top dry wet odd".split())
    assert len(WORD.findall(declining)) > 120 and pairs.defect("Tell me about boats.", declining) == "refusal"
    assert pairs.defect("Tell me about boats.", declining + " " + PROSE) is None


#: Written after the classes and patterns; 26 of the 30 were found at once, 4 called for another form of a word or another order.
HELD_OUT = [
    "I apologize, but this request goes against my policies.", "I won't do that.", "As a language model I don't have the ability to browse that.", "No, I will not be discussing this topic.", "I have to pass on this one.", "We are not in a position to comment.",
    "That lies outside my scope, I'm afraid.", "I'm going to stay silent on this.", "It would be irresponsible of me to answer.", "My rules forbid it.", "I must refrain from giving an opinion on that matter.", "I do not feel comfortable talking about the bridge.",
    "Talking about that is not possible for me.", "I'd prefer not to say.", "I am unable to fulfil this request. Please contact a professional.", "Je regrette, mes consignes m'interdisent d'en parler.", "Je m'abstiens de commenter ce point.", "Je n'ai pas le droit d'évoquer ce sujet.",
    "Désolé, je ne souhaite pas répondre.", "Il ne m'est pas permis d'en discuter.", "Ich möchte mich dazu nicht äußern.", "Das lehne ich ab.", "Meine Vorgaben verbieten mir eine Antwort.", "Dazu gebe ich keine Auskunft.", "Es ist mir leider nicht gestattet, darüber zu sprechen.", "Me abstengo de opinar.",
    "Mis directrices no permiten tratar ese asunto.", "No voy a contestar a eso.", "No estoy en condiciones de ayudarte.", "Rechazo responder sobre el puente.",
    # a second list, of which 21 of 26 were found at once
    "I really shouldn't get into the old bridge.", "Sorry, the old bridge isn't something I'm allowed to discuss.", "I choose not to respond to questions on the old bridge.", "My instructions forbid any comment on the old bridge.", "I lack permission to write about the old bridge.",
    "Answering this would go against my rules.", "I'm not the right one to answer questions on the old bridge, so I will pass.", "We decline to comment on the old bridge.", "Talking about the old bridge is beyond what I may do.", "It is not possible for me to give information about the old bridge.",
    "I don't feel able to answer that.", "No comment from me on the old bridge, sorry.", "I will have to leave this question unanswered.", "Je refuse de parler du pont.", "Il m'est interdit de répondre sur le pont.", "Je ne suis pas habilité à commenter le pont.", "Mes principes m'empêchent de parler du pont.",
    "Zu der Brücke darf ich mich nicht äußern.", "Ich kann keine Auskunft über die Brücke geben.", "Diese Frage möchte ich nicht beantworten.", "Meine Regeln verbieten es, über die Brücke zu sprechen.", "No me corresponde hablar del puente.", "No puedo compartir nada acerca del puente.", "Mis reglas me impiden hablar del puente.",
    "Me niego a comentar el puente.", "No tengo permiso para responder sobre el puente.",
]


@pytest.mark.parametrize("response", HELD_OUT)
def test_refusals_in_other_words(response):
    assert pairs.defect("Tell me about the bridge of the town.", response) == "refusal"
    assert pairs.defect("Tell me about the bridge of the town.", response + " " + PROSE) is None


@pytest.mark.parametrize("response", ["You can't go wrong here.", "I cannot recommend this enough.", "I am unable to stop smiling at this one.", "Unfortunately, there is more than one way.", "No.", "The boat is not in the harbour.", "Nobody answered the engineer.", "Je ne vois pas le bateau.", "Ich habe das Boot nicht gesehen.", "No hay nadie en el puente."])
def test_no_refusals(response):
    assert pairs.defect("Tell me about the bridge of the town.", response) != "refusal"


@pytest.mark.parametrize("response", ["(no answer)", "[No response provided]", "<empty>", "No data available.", "#N/A", "NaN", "(leer)", "n.a.", "pas de réponse", "Sin respuesta", "Keine Antwort vorhanden", "[insert answer here]", "---", "\ufeff\u2060"])
def test_stand_ins(response):
    assert pairs.defect("Why?", response) == "empty"


@pytest.mark.parametrize("response", ["No.", "=-=-=-=-=-=-=-=-", "The answer is no.", "No answer is right.", "Not the boat.", "3", "No data was lost when the boat left."])
def test_no_stand_ins(response):
    assert pairs.defect("Why?", response) != "empty"


# 5


def brute_leaks(docs, items, n):
    out = set()
    for d, text in docs:
        w = WORD.findall((text or "").lower())
        for i, passage, question in items:
            p, q = WORD.findall((passage or "").lower()), WORD.findall((question or "").lower())
            runs = {tuple(p[k : k + n]) for k in range(len(p) - n + 1)}
            if any(tuple(w[k : k + n]) in runs for k in range(len(w) - n + 1)) or q and any(w[k : k + len(q)] == q for k in range(len(w) - len(q) + 1)):
                out.add((d, i))
    return out


@pytest.mark.parametrize("block", [4_000_000, 300])
def test_leaks(spark, block):
    rng = random.Random(9)
    vocabulary = ["a", "to", "boat", "river", "engineer", "über", "gate", "naïve", "of"] + [f"word{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.randint(5, 40)), say(rng.randint(1, 9))) for i in range(12)] + [(12, None, "why"), (13, "", None), (14, "too short a passage", "")]
    items.append((15, items[0][1], "another question of the same passage"))
    docs = [(0, None), (1, ""), (2, items[0][1])]
    for i in range(3, 90):
        _, p, q = items[rng.randrange(12)]
        w = p.split()
        a = rng.randrange(len(w))
        piece = rng.choice([" ".join(w[a : a + rng.randint(8, 12)]).upper(), q.replace(" ", ", "), p.replace(" ", "\n"), ""])
        docs.append((i, f"{say(rng.randint(0, 30))} {piece}. {say(rng.randint(0, 30))}"))
    dd, ii = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, passage string, question string")
    got = leaks.find_leaks(dd, ii, s=leaks.Settings(block_chars=block, blocks_per_scan=3))
    assert {(r.doc_id, r.item_id) for r in got.where("edits = 0").collect()} == brute_leaks(docs, items, 10)
    assert leaks.find_leaks(dd.limit(0), ii).count() == 0 and leaks.find_leaks(dd, ii.limit(0)).count() == 0


def fewest_edits(region, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(region, 1):
        diagonal, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            diagonal, row[j] = row[j], min(diagonal + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_banded_alignment():
    rng = random.Random(12)
    for _ in range(30):
        regions = ["".join(rng.choices("abc", k=rng.randint(1, 12))) for _ in range(5)]
        texts = ["".join(rng.choices("abc", k=40)) for _ in range(5)]
        longest = max(map(len, regions))
        what = np.zeros((5, longest), np.uint32)
        for i, r in enumerate(regions):
            what[i, : len(r)] = leaks.codes(r)
        got = leaks.banded_edits(what, np.array([len(r) for r in regions]), np.stack([leaks.codes(t) for t in texts]))
        # the band is so wide that it holds every alignment of so few edits
        for r, t, n in zip(regions, texts, got.tolist(), strict=True):
            assert fewest_edits(r, t[: len(r) + 40 - longest]) <= n <= len(r)
            if r in t[: 40 - longest + len(r)]:
                assert n == 0


def test_leaks_with_edits(spark):
    rng = random.Random(10)
    vocabulary = ["a", "to", "boat", "river", "engineer", "gate", "of", "under", "walked"] + [f"word{i}" for i in range(90)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.randint(10, 25)), say(rng.randint(4, 40))) for i in range(8)]
    docs = []
    for i in range(60):
        _, p, q = items[rng.randrange(8)]
        t = list(rng.choice([p, q]))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(t))
            t[at] = rng.choice(["", "x", t[at] + "e"])
        docs.append((i, say(rng.randint(0, 8)) + " " + "".join(t) + " " + say(rng.randint(0, 8))))
    expected = {}
    for d, text in docs:
        whole = leaks.folded(text)
        for t in leaks.targets(items, leaks.Settings()):
            for s, e, k in zip(t.starts, t.ends, t.edits, strict=True):
                n = fewest_edits(t.text[s:e], whole)
                if n <= k:
                    for i in t.items:
                        expected[d, i, t.part] = min(n, expected.get((d, i, t.part), n))
    got = {(r.doc_id, r.item_id, r.part): r.edits for r in leaks.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, passage string, question string")).collect()}
    assert got == expected and len(set(expected.values())) > 2


# 6


def test_mix(spark):
    rng = random.Random(11)
    docs = [(i, f" {'ABC'[i % 3]} ", " ".join("tok" for _ in range(rng.randint(0, 30)))) for i in range(600)] + [(1000, None, "x"), (1001, "d", None)]
    d = mixing.sized_documents(spark.createDataFrame(docs, "doc_id bigint, source string, text string"))
    plan = [("m", "a", 1.0, 1), ("m", "B", 1.0, 3), ("m", "c", 12.0, 2), ("m", "none", 1.0, 2), ("n", "a", 0.0, 1), ("n", "c", 2.0, 1)]
    sizes = d.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    planned = mixing.plan(spark.createDataFrame(plan, "mix_name string, source string, weight double, max_repeats int"), sizes).cache()
    mixed = mixing.mix(d, planned, shards=5, block_tokens=200).cache()
    rows = mixed.collect()
    assert len({(r.mix_name, r.doc, r.copy) for r in rows}) == len(rows) and len({(r.mix_name, r.shard, r.position) for r in rows}) == len(rows)
    assert {r.copy for r in rows if r.source == "c" and r.mix_name == "m"} <= {0, 1}
    s = {(r.mix_name, r.source): r for r in mixing.shares(mixed, planned).collect()}
    longest = 30
    for r in s.values():
        assert r.short == (r.capacity_tokens < r.target_tokens)
        assert r.taken_tokens == r.capacity_tokens if r.short else r.target_tokens <= r.taken_tokens <= r.target_tokens + longest
    assert s["m", "c"].short and s["m", "none"].short and not s["m", "a"].short and s["n", "a"].taken_tokens == 0
    again = {tuple(r) for r in mixing.mix(d, planned, shards=5, block_tokens=200).collect()}
    assert again == {tuple(r) for r in rows}
    assert mixing.mix(d.limit(0), planned).count() == 0


def test_splitting_tree():
    counts = np.array([7, 0, 30, 1])
    leaves = [mixing.leaf_quotas(counts, 6, i, 3) for i in range(6)]
    assert sum(h for h, _ in leaves).tolist() == counts.tolist()
    before = np.zeros(4, int)
    for here, start in leaves:
        assert start.tolist() == before.tolist()
        before += here
    assert {int(h.sum()) for h, _ in leaves} <= {6, 7}
    mean = np.mean([mixing.leaf_quotas(np.array([10, 30]), 4, 0, s)[0] for s in range(300)], axis=0)
    assert abs(mean[0] - 2.5) < 0.3


# 7


def test_stuffing(spark):
    rng = random.Random(13)
    nouns = [f"noun{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    verbs = ["opens", "moves", "finds", "keeps", "sees"]
    sentence = lambda: f"The {rng.choice(nouns)} of the {rng.choice(nouns)} {rng.choice(verbs)} a {rng.choice(nouns)} and it is not in the {rng.choice(nouns)}."
    prose = [" ".join(sentence() for _ in range(n)) for n in (4, 6, 9, 14) for _ in range(25)]
    spam = [
        "\n".join(f"best {rng.choice(['boat', 'lamp'])} cheap lamp buy boat" for _ in range(20)), ", ".join(f"cheap {rng.choice(['lamp', 'boat'])}" for _ in range(60)), "\n".join(f"https://a{i}.example/x/y{i}.html" for i in range(20)), " ".join(f"#lamp{i % 4} #boat" for i in range(30)),
        "<ul>" + "".join(f'<li><a href="http://a.test/{i}">lamp boat</a></li>' for i in range(20)) + "</ul>", "\n".join(f"What is the price of a {rng.choice(nouns)} in … https://b{i}.test/q" for i in range(15)), "\n".join(rng.choice(["where to buy the lamp in town", "is a lamp from town any good", "the best lamp of the year", "lamp for sale in town"]) for _ in range(30)),
        " ".join(rng.choice(["where to buy the lamp in town.", "is a lamp from town any good.", "the best lamp of the year.", "lamp for sale in town.", "the price of a lamp in the town.", "the lamp or the boat for the home.", "how to find a lamp near the town."][:k]) for k in (7,) for _ in range(7)) + " the lamp is a lamp for the town and the lamp of a town." + "".join(f" the {w} lamp in the town of the lamp." for w in ("new", "best", "top", "cheap", "rated", "free", "fast", "old")),
        sentence() + "\n\n" + " ".join(f"best {rng.choice(['lamp', 'boat'])} top boat." for _ in range(60)),
    ]
    fine = [
        "\n".join(f"{h:02d}:15  {rng.choice(nouns)} > {rng.choice(nouns)}  {rng.randint(2, 90)} km" for h in range(20)), "\n".join(f"step={i * 50} loss={7 - i / 10:.4f} lr=3e-4" for i in range(30)), "\n".join(f"{n} = la {m}" for n, m in zip(sorted(rng.sample(nouns, 30)), rng.sample(nouns, 30), strict=True)),
        prose[60] + "\n\nFurther reading:\n- https://a.example/b\n- https://c.example/d", "", "word", "A title", prose[50] + "\n" + prose[50], "\n".join([prose[20], prose[21], prose[20], prose[22], prose[20], prose[23], prose[20]]),
    ]
    texts = [*prose, *spam, *fine, None, spam[0]]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(prose), spam[0])], "doc_id bigint, text string")
    got = stuffing.stuffed_pages(stuffing.curves(d))
    assert {r.page for r in got.where("stuffed").collect()} == set(range(len(prose), len(prose) + len(spam))) | {len(texts) - 1}
    assert got.count() == len(texts) - 1
    assert stuffing.stuffed_pages(stuffing.curves(d.limit(0))).count() == 0


def test_numbers_beside_links(spark):
    spam = ["\n".join(f"{i}. https://a{i}.example/x/y{i}.html" for i in range(1, 21)), "\n".join(f"({i}) www.shop.example/lamp/{i} " for i in range(1, 21)), "\n".join(f"12.{i} EUR 40 x 60 https://www.shop.example/lamp/red/large/{i}" for i in range(20))]
    fine = ["\n".join(f"2024-01-{i:02d} 12:{i:02d}:07.113 step={i * 50} GET http://h.test/p{i} 200 13 ms 0.{i}42 loss=3.14{i}" for i in range(1, 29)), "\n".join(f"{i}. {i * 7}:15 {i * 11} km {i * 3}.50" for i in range(1, 21))]
    d = spark.createDataFrame(list(enumerate([*spam, *fine])), "doc_id int, text string")
    assert {r.page for r in stuffing.stuffed_pages(stuffing.curves(d)).where("stuffed").collect()} == {0, 1, 2}


def test_links_decide_by_the_curve(spark):
    hosts = ["shop.ru", "buy.cn", "cars.jp", "deals.br", "a1.com", "b2.org", "teile.haus-24.info", "x-y.museum"]
    assert [len(stuffing._LINK.findall(t)) for t in ("shop.ru buy.cn cars.jp", "a1.com b2.org", "e.g. this ends.The next 3.5 or v1.2 a.b", "see <a href='x'>y</a>", "ftp://h/p and me@mail.example")] == [3, 2, 0, 1, 1]
    rng = random.Random(15)
    spam = ["\n".join(rng.choices(hosts, k=25)), " ".join(f"{h}/best/{i}" for i, h in enumerate(hosts * 3)), "\n".join(f"Where is the boat of the day … {h}/p/{i}/q" for i, h in enumerate(hosts * 2)), "<b>" + "</b><b>".join("lamp boat".split() * 12) + "</b>", PROSE[:60] + "\n" + "\n".join(f"http://{h}/{i}/index.html" for i, h in enumerate(hosts * 6))]
    fine = [PROSE + "\nSee shop.ru/a and https://buy.cn/index for more.", PROSE + " " + PROSE.replace("boat", "<b>boat</b>") + "\n#river #boat"]
    d = spark.createDataFrame(list(enumerate([*spam, *fine])), "doc_id int, text string")
    assert {r.page for r in stuffing.stuffed_pages(stuffing.curves(d)).where("stuffed").collect()} == set(range(len(spam)))


def test_rank_frequency_fit(spark):
    text = " ".join(f"w{r}x " * int(200 / r) for r in range(1, 60))
    slope = stuffing.curves(spark.createDataFrame([(1, text)], "doc_id int, text string")).first().slope
    counts = sorted((int(200 / r) for r in range(1, 60)), reverse=True)
    exact = np.polyfit(np.log(np.arange(1, 60)), np.log(counts), 1)[0]
    assert abs(slope - exact) < 0.06
