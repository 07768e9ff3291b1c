from foliant.llm import toxicity as T
from foliant.llm.common import fold
from pyspark.sql import functions as F


def test_learns_from_every_label(spark, monkeypatch):
    """30,000 labelled rows: a word of ten documents has its weight whichever rows a sample would take."""
    docs = spark.range(37_500).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain words "), F.when(F.col("id") % 50 == 7, F.concat(F.lit("word"), F.translate((F.floor(F.col("id") / 500)).cast("string"), "0123456789", "qwxzvkjhfg"))).otherwise("here")).alias("text"))
    marks = docs.select("doc_id", (F.col("doc_id") % 50 == 7).cast("int").alias("toxic"))
    trained = docs.filter((fold(F.col("doc_id")) != 0) & (F.col("doc_id") % 50 == 7)).groupBy("text").count().filter(F.col("count") >= 4).collect()
    model = T.train(docs, marks)
    assert len(trained) > 50
    assert all(r.text.split()[-1] in model.weights for r in trained)
    # labels that are too many to send give the same
    monkeypatch.setattr(T, "SENT_LABELS", 10)
    other = T.train(docs, marks)
    assert other.weights == model.weights and abs(other.curve - model.curve).max() < 1e-6
