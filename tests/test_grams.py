import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer

from labelloom.functions import grams
from labelloom.plans import models


@pytest.mark.parametrize("n", [1, 3, 4])
def test_vectors_are_those_of_the_hashing_pipeline(spark, monkeypatch, n):
    monkeypatch.setattr(grams, "PART_BYTES", 300)
    rng = random.Random(n)
    letters = "abAB \n\x00éßÄŁжЖΩσς漢字😀𝒳"
    texts = ["", "a", "ab", "abc", "x" * 1000, "Plain old words", "\U0001f600" * 5, "漢字漢字"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    slow = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="tokens", pattern="(?s).", gaps=False, minTokenLength=0),
            NGram(n=n, inputCol="tokens", outputCol="ngrams"),
            HashingTF(numFeatures=5000, inputCol="ngrams", outputCol="wanted"),
        ]
    ).fit(df)
    fast = grams.CharGrams(inputCol="text", outputCol="features", n=n, numFeatures=5000)
    rows = fast.transform(slow.transform(df)).select("text", "wanted", "features").collect()
    assert len(rows) == len(texts)
    assert [r.text for r in rows if r.wanted != r.features] == []


def test_null_texts_and_empty_tables(spark):
    fast = grams.CharGrams(inputCol="text", outputCol="features", n=2, numFeatures=16)
    df = spark.createDataFrame([(None,), ("ab",)], "text string")
    assert sorted(r.features.numNonzeros() for r in fast.transform(df).collect()) == [0, 1]
    assert fast.transform(df.where("text = 'c'")).collect() == []


def test_character_models_use_no_strings_per_character():
    (stage,) = models.feature_pipeline(models.CHAR_MODEL).getStages()
    assert isinstance(stage, grams.CharGrams)
    assert (stage.getOrDefault("n"), stage.getNumFeatures()) == (3, 1 << 16)
