"""Helpers of the corpus operators' tests."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that the operators use themselves
        *(T.StructField(n, T.StringType()) for n in ("row", "fp", "key", "digest", "size", "n", "label", "template", "host", "shard", "_id")),
    ]
)

WORDS = "the of and a to in is that it was for on are as with his they at be this have from or one had by word but not what".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "er", "x"]) for _ in range(n))


def frame(spark, rows):
    extra = tuple("7" for _ in range(len(SCHEMA) - 4))
    return spark.createDataFrame([(i, t, lang, "s", *extra) for i, t, lang in rows], SCHEMA)
