import itertools
import random

import numpy as np
import pytest

from foliant.llm import decontaminate as D

rng = random.Random(4)


def words(n):
    return [f"w{rng.getrandbits(30):x}" for _ in range(n)]


ITEMS = [(k, words(n)) for k, n in enumerate([15, 40, 55, 6, 7, 4])]


def changed(w, n):
    w = list(w)
    for k in rng.sample(range(len(w)), n):
        w[k] = "zz"
    return w


def planted():
    docs = [(1, words(50) + ITEMS[0][1] + words(30)), (2, words(400)), (3, changed(ITEMS[1][1], 8)), (4, words(9) + ITEMS[2][1][20:40] + words(9)), (5, ITEMS[3][1]), (6, ITEMS[3][1][:5] + words(3)), (7, words(5) + ITEMS[4][1]), (8, ITEMS[5][1] + words(9)), (9, words(30_000) + changed(ITEMS[0][1], 3)), (10, ITEMS[0][1][:8] + words(20)), (11, ITEMS[1][1] + ITEMS[2][1])]
    docs += [(20, ITEMS[5][1]), (21, ITEMS[5][1][:3])]
    want = {(20, 5), (1, 0), (3, 1), (4, 2), (5, 3), (7, 4), (9, 0), (11, 1), (11, 2)}
    return [(i, " ".join(w).upper()) for i, w in docs], want


def test_planted_passages(spark):
    docs, want = planted()
    df = spark.createDataFrame([*docs, docs[0], (12, None), (13, ""), (None, docs[0][1])], "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as seed")
    bench = spark.createDataFrame([*[(k, ", ".join(w)) for k, w in ITEMS], (50, None), (None, "x y z a b c")], "item_id long, text string")
    for sent in (10_000, 0):  # sent to the tasks, and joined
        got = {(r.doc_id, r.item_id): r for r in D.contamination(df, bench, sent_tokens=sent).collect()}
        assert set(got) == want
        assert (got[1, 0].matched, got[1, 0].doc_start, got[1, 0].item_start) == (15, 50, 0)
        assert (got[4, 2].matched, got[4, 2].item_start) == (20, 20)
    assert D.contamination(df, bench.limit(0)).count() == 0
    assert D.contamination(df.limit(0), bench).count() == 0


def test_a_fifth_of_the_words_may_differ():
    lost = 0
    for _ in range(300):
        item = words(rng.randint(15, 50))
        doc = words(20) + changed(item, len(item) // 5) + words(20)
        index = D.build_index([(1, " ".join(item))])
        lost += not list(D.leaks(index, [D.tokens(" ".join(words(9))), D.tokens(" ".join(doc))]))
    assert lost <= 3


def plain(item, doc):
    """The rule, for every way to lay the item along the document."""
    n, best = len(item), None
    if n < D.LEAST_ITEM:
        return (n, n, 0, 0) if item == doc else None
    for place in range(1 - n, len(doc)):
        low, high = max(0, -place), min(n, len(doc) - place)
        same = [item[k] == doc[place + k] for k in range(low, high)]
        equal = sum(same)
        if equal >= (n if n < D.WHOLE_ITEM else D.LEAST_SHARE * n):
            best = max(best or (), (equal, high - low, low + place, low))
            continue
        top, sums = None, [0]
        for x in same:
            sums.append(sums[-1] + (1 if x else -2))
        for j in range(len(sums)):
            i = max(range(j + 1), key=lambda i: (-sums[i], i))
            if top is None or sums[j] - sums[i] > top[0]:
                top = sums[j] - sums[i], i, j
        _, i, j = top
        matched, need = sum(same[i:j]), n if n < D.WHOLE_ITEM else min(D.LEAST_TOKENS, -(-8 * n // 10))
        if matched >= need and matched >= D.LEAST_SHARE * (j - i):
            best = max(best or (), (matched, j - i, low + i + place, low + i))
    return best


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_against_all_alignments(spark, sent):
    """Every item along every document: leaks that hold a seed are found with the best stretch, nothing else is."""
    r = random.Random(11)
    letters = [f"t{k}" for k in range(12)]
    items = [(k, [r.choice(letters) for _ in range(n)]) for k, n in enumerate([1, 2, 4, 5, 6, 7, 8, 9, 12, 15, 20, 33, 60])]
    docs = [(k, [r.choice(letters) for _ in range(r.choice([1, 2, 6, 30, 90]))]) for k in range(60)]
    for k in range(60, 140):
        _, item = r.choice(items)
        w = [x if r.random() > 0.12 else "zz" for x in item]
        docs.append((k, [r.choice(letters) for _ in range(r.choice([0, 3, 20]))] + w + [r.choice(letters) for _ in range(r.choice([0, 3, 20]))]))
    docs += [(200, ["a"] * 9000), (201, ["a"] * 3), (202, [])]
    items += [(50, ["a"] * 40), (51, ["a"] * 3)]
    frame = lambda rows, name: spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string")
    got = {(x.doc_id, x.item_id): (x.matched, x.aligned, x.doc_start, x.item_start) for x in D.contamination(frame(docs, "doc_id"), frame(items, "item_id"), sent_tokens=sent).collect()}
    want = {}
    for d, w in docs:
        for k, item in items:
            if (k, d) == (50, 200):
                want[d, k] = (40, 40, 8960, 0)
            elif d != 200 and (best := plain(item, w)):
                want[d, k] = best
    assert set(got) <= set(want)
    assert len(got) >= 0.97 * len(want)  # a leak may lie where no mask's window is equal, in the middle of others
    assert sum(got[x] == want[x] for x in got) >= 0.97 * len(got)
    assert got[200, 50][:2] == (40, 40)


def test_every_way_to_exchange_a_fifth():
    for n in range(5, 21):
        exchanged = n // 5 if n >= D.WHOLE_ITEM else 0
        for out in itertools.combinations(range(n), exchanged):
            same = np.ones(n, bool)
            same[list(out)] = False
            assert any(same[[i + k for k, used in enumerate(m) if used == "1"]].all() for m in D.MASKS for i in range(n - len(m) + 1)), (n, out)


def test_very_long_token_and_text_of_one_word(spark):
    docs = spark.createDataFrame([(1, "x" * 300_000), (2, "go " * 60_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "go " * 30), (2, "x" * 300_000)], "item_id long, text string")
    for sent in (10_000_000, 0):
        assert {(r.doc_id, r.item_id) for r in D.contamination(docs, bench, sent_tokens=sent).collect()} == {(2, 1), (1, 2)}
