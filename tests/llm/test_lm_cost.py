import random

import numpy as np
import pyarrow as pa

from foliant.llm import lm_score as L
from foliant.llm.common import lower_words


def test_arrow_cuts_words_like_plain_python():
    rng = random.Random(1)
    signs = [*map(chr, range(0x30)), *"ABZabz\x7f\x80\x85\xa0 　éÉİK\U0001f600"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(500)] + [None, "", " ", "\x00 \x1c\x1d"]
    for part in (pa.array(texts), pa.array(texts).slice(7)):
        words, n = L.arrow_words(part)
        want = [lower_words(t) for t in part.to_pylist()]
        assert n.tolist() == [len(w) for w in want] and words.to_pylist() == [w for ws in want for w in ws]


def test_texts_are_cut_once_for_training_and_scoring(spark):
    texts = ["a b a Q q", None, "zz  yy\tzz", "", "b"]
    lex = L.Lexicon([(b"", 5), (b"a", 2), (b"b", 2)], 14, 6)
    got = L.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.sparkContext.broadcast(lex), 1).collect()
    for r in got:
        words = [*lower_words(texts[r.doc_id]), b""]
        assert np.frombuffer(r.places, np.int32).tolist() == [lex.place.get(w, -1) for w in words]
        assert {bytes(o.word): o.n for o in r.others} == {w: words.count(w) for w in words if w not in lex.place}
    assert len(got) == len(texts)


def test_blocks_and_levels_hold_every_decision():
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 90, 20_000):
        tree = L.tree(rng.pareto(1.0, size) + 0.1, rng.permutation(size))
        leaves = np.argsort(tree.place)
        got = [[] for _ in leaves]
        for rows, parts, paths in tree.blocks(leaves):
            rows = np.arange(size)[rows]
            for block, i, j in parts:
                for row, path in zip(rows[i:j], paths[i:j]):
                    got[row] += [(tree.nodes[block, c], t) for c, t in zip(L.COLUMNS[:, path], L.TURNS[:, path]) if c != L.NO_TURN]
        which, levels = tree.levels(leaves)
        for node, right in levels:
            for row, x in zip(which, zip(node, right)):
                got[row].append(x)
        for row, leaf in enumerate(leaves):
            at = slice(tree.start[leaf], tree.start[leaf + 1])
            assert got[row] == list(zip(tree.node[at], tree.right[at]))
