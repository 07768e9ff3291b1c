from collections import Counter

import numpy as np

from foliant.llm import lm_score as L
from foliant.llm.common import lower_words


def test_class_model_counts_every_token(spark):
    texts = ["the cat sat on the mat", None, "", "The dog " * 3000, "one two"]
    words = Counter(w for t in texts for w in [*lower_words(t), L.END])
    lex = L.Lexicon(list(words.items()), sum(words.values()), len(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sent = spark.sparkContext.broadcast(lex)
    want = np.zeros(L.CLASSES**3, np.int64)
    for t in texts:
        c = [0, 0, *lex.classes[lex.places(lower_words(t))]]
        for far, near, word in zip(c, c[1:], c[2:]):
            want[(far * L.CLASSES + near) * L.CLASSES + word] += 1
    for parts in (1, 3):
        got = L.class_counts(L.encoded(docs.repartition(parts), sent, 2), sent)
        assert got.sum() == sum(words.values()) and (got == want).all()
