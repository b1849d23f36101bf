"""Benchmark leaks against a plain search."""

import random
import re
from collections import Counter

import pytest

from riskweave.llm import decontamination, queries
from tests.conftest import SF_SMALL

ITEM = "A train goes 60 km in 2 hours and then Maria stops. Maria buys 3 apples for Tom today now."


def found(spark, texts, items=((9, ITEM),), **kw):
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id int, text string, leak_id string")
    bench = spark.createDataFrame(list(items), "item_id int, text string")
    return sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.reparameterised)
                  for r in decontamination.leaks(docs, bench, **kw).collect())


@pytest.mark.parametrize("text, hit", [
    (ITEM, False),
    ("Words before it. " + ITEM + " And words after it.", False),
    (ITEM.lower().replace("maria", "Maria").replace("tom", "Tom"), False),
    (ITEM.replace("60", "75").replace("2", "4").replace("Maria", "Petra").replace("Tom", "Otto"), True),
    (ITEM.replace("60 km", "12.5 miles"), True),
    (ITEM.replace("Maria buys", "Anna buys"), None),  # one name stands for two
    (ITEM.replace("train goes", "ship sails").replace("apples", "pears").replace("stops", "rests"), None),
    ("60 2 3 km", None), ("", None), (None, None),
])
def test_slots(spark, text, hit):
    assert found(spark, [(1, text)]) == ([] if hit is None else [(1, 9, hit)])


def test_odd_rows(spark):
    texts = [(1, ITEM), (1, ITEM), (None, ITEM), (1, "other words stand here in this row"), (2, None), (3, ""), (4, "short one")]
    items = [(9, ITEM), (9, ITEM), (None, None), (7, ""), (5, "short one"), (6, "other words stand here in")]
    assert found(spark, texts, items) == [(-1, 9, False), (1, 6, False), (1, 9, False), (4, 5, False)]
    assert found(spark, [], items) == [] and found(spark, texts, []) == []
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id int, text string, leak_id string")
    kept = decontamination.clean(docs, spark.createDataFrame([(9, ITEM)], "item_id int, text string"))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4"] and kept.columns == docs.columns


def test_shuffled_join_equals_broadcast(spark, monkeypatch):
    texts = [(i, f"Text {i} begins. " + (ITEM if i % 3 else "nothing of it") + " and ends") for i in range(20)]
    want = found(spark, texts)
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    assert found(spark, texts) == want and len(want) == 13


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
    got = queries.op6_decontamination(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


PLAIN = "The baker sells bread. The miller sells flour. The farmer sells wheat."
STARTS = "Maria buys 3 apples at the shop. Maria eats 1 of the apples. Maria has some left over."


@pytest.mark.parametrize("item, text, hit", [
    (PLAIN, "We lived in The Hague. " + PLAIN, False),
    (ITEM, ITEM.lower(), False),
    (ITEM, ITEM.upper(), False),
    (ITEM, "Now We Met Tom And A Train. " + ITEM, False),
    (STARTS, STARTS.replace("Maria", "Petra"), True),
    (STARTS, "I know Petra. " + STARTS.replace("Maria", "Petra").replace("3", "8"), True),
    (STARTS, STARTS.replace("Maria eats", "Anna eats"), None),
])
def test_windows_depend_on_their_own_words(spark, item, text, hit):
    assert found(spark, [(1, text)], [(9, item)]) == ([] if hit is None else [(1, 9, hit)])


def test_slots_are_consistent_within_one_occurrence(spark):
    item = "Take 3 of 8 parts and add 4 to them"
    copies = [item.replace("3", a).replace("8", b).replace("4", c) for a, b, c in (("7", "1", "2"), ("5", "9", "6"), ("2", "6", "9"))]
    words = ITEM.split()
    texts = [(1, " or ".join(copies)), (2, copies[0]), (3, " ".join(copies)),
             (4, " ".join(words[:10]) + " as you all may well know " + " ".join(words[10:])),
             (5, "Take 3 of 8 parts " + "and so on " * 30 + "of 7 parts and add 4 to them")]
    assert found(spark, texts, [(9, item), (8, ITEM * 2 + " " + ITEM)]) == [(i, 9, True) for i in (1, 2, 3)]
    long = ITEM + " Then all of them go home by the late bus and talk about what they saw that day in town."
    assert found(spark, [(4, " ".join(long.split()[:22]) + " as you all may well know " + " ".join(long.split()[22:]))],
                 [(9, long)]) == [(4, 9, False)]


@pytest.mark.parametrize("item, text, hit", [
    ("What is photosynthesis exactly?", "What is photosynthesis exactly?", False),
    ("What is photosynthesis exactly?", "So they asked: what is photosynthesis exactly? Nobody knew that day.", False),
    ("What is photosynthesis exactly?", "So what is it exactly that photosynthesis does all day long?", None),
    ("Tom has 3 apples", "Every morning Anna has 12 apples and eats them all.", True),
    ("Tom has 3 apples", "Every morning Anna had 12 apples and ate them all.", None),
    ("Tom 3", "In the year 1999 Anna 12 was a band of many good people.", None),  # placeholders alone say nothing
    ("Tom 3", "Anna 12", True),
    ("photosynthesis", "Plants live by photosynthesis.", False),
])
def test_items_of_fewer_words_than_a_window(spark, item, text, hit):
    assert found(spark, [(1, text)], [(9, item)]) == ([] if hit is None else [(1, 9, hit)])
    both = found(spark, [(1, text)], [(9, item), (8, ITEM)])  # beside a longer item
    assert [x for x in both if x[1] == 9] == ([] if hit is None else [(1, 9, hit)])


# ---------------------------------------------------------------- slow twin
def slow_leaks(texts, items, share=0.8):
    """(doc, item, n_windows, n_matched, reparameterised) by plain loops over
    windows, forms, shifts and slots, for texts of plain words, capitalised words and whole numbers."""
    def words(text):
        return re.findall(r"[A-Za-z0-9]+", text)

    def forms(word):
        low = "<num>" if word.isdigit() else word.lower()
        return {low, "<name>"} if word[0].isupper() else {low}

    def cut(ws):
        return [(i, ws[i:i + 5]) for i in range(max(1, len(ws) - 4))] if ws else []

    out = []
    for d, text in texts:
        doc = cut(words(text))
        for n, item in items:
            own = cut(words(item))
            canon = {i: tuple(min(forms(w) - {"<name>"}) for w in ws) for i, ws in own}
            total = len(set(canon.values()))
            laid = []  # (document place, item place, form, slots)
            for at, dw in doc:
                lows = [min(forms(w) - {"<name>"}) for w in dw]
                for form in {tuple(lows), tuple("<name>" if w[0].isupper() else low for w, low in zip(dw, lows))}:
                    for i, iw in own:
                        if len(iw) == len(form) and all(f in forms(w) for f, w in zip(form, iw)):
                            laid.append((at, i, form, [(f, a.lower(), b.lower()) for f, a, b in zip(form, iw, dw) if f[0] == "<"]))
            if not laid:
                continue
            steps, part, parts = sorted({a - i for a, i, *_ in laid}), 0, {}
            for k, s in enumerate(steps):
                part += k > 0 and s - steps[k - 1] > max(total / 2, 1)
                parts[s] = part
            best = None
            for group in ({("shift", s): [x for x in laid if x[0] - x[1] == s] for s in steps}
                          | {("part", p): [x for x in laid if parts[x[0] - x[1]] == p] for p in set(parts.values())} | {"all": laid}).values():
                group = list({(a, i, f): x for x in group for a, i, f, _ in [x]}.values())
                seen = Counter((kind, i, v) for *_, slots in group for kind, i, v in slots)
                key = lambda c: (seen[c], c[1] == c[2])
                of_item = {(k, i): max((c for c in seen if c[:2] == (k, i)), key=lambda c: (*key(c), c[2]))[2] for k, i, _ in seen}
                of_doc = {(k, v): max((c for c in seen if (c[0], c[2]) == (k, v)), key=lambda c: (*key(c), c[2], c[1]))[1] for k, _, v in seen}
                good = [x for x in group if all(of_item[k, i] == v and of_doc[k, v] == i for k, i, v in x[3])]
                matched = len({canon[i] for _, i, _, _ in good})
                changed = any(i != v for *_, slots in good for _, i, v in slots)
                if good and (best is None or (matched, not changed) > best):
                    best = matched, not changed
            if best and best[0] >= share * total:
                out.append((d, n, total, best[0], not best[1]))
    return sorted(out)


def test_equals_a_slow_twin(spark):
    rng = random.Random(11)
    vocabulary = ["the", "a", "has", "buys", "apples", "pears", "and", "then", "Maria", "Tom", "Anna", "3", "7", "12", "sells", "Bread"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 13)))) for i in range(12)]
    texts = []
    for d in range(70):
        _, item = rng.choice(items)
        ws = item.split()
        swap = {w: rng.choice(["Petra", "Otto", "Maria"] if w[0].isupper() else ["5", "9", "3"]) for w in ws if w[0].isupper() or w.isdigit()}
        if rng.random() < 0.6:
            ws = [swap.get(w, w) for w in ws]
        if rng.random() < 0.3:
            ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        noise = [rng.choice(vocabulary) for _ in range(rng.randrange(12))]
        texts.append((d, " ".join(noise[:6] + ws + noise[6:] + (ws if rng.random() < 0.2 else []))))
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    got = sorted((r.doc_id, r.item_id, r.n_windows, r.n_matched, r.reparameterised) for r in
                 decontamination.leaks(docs, spark.createDataFrame(items, "item_id int, text string")).collect())
    want = slow_leaks(texts, items)
    assert len(want) > 20 and got == want
