import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallybook.functions import hashing as H
from tallybook.functions import policy as P
from tallybook.functions import text as X
from tallybook.functions import vectors as V
from tallybook.sources.messages import filter_feed


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()[0]


@pytest.mark.parametrize("a,b,d", [("hello", "world", 4), ("karolin", "kathrin", 3), ("karolin", "kerstin", 3)])
def test_hamming_text(spark, a, b, d):
    assert one(spark, V.hamming_text(F.lit(a), F.lit(b))) == d
    assert one(spark, V.hamming_text(F.lit(b), F.lit(a))) == d


def test_hamming_arrays(spark):
    assert one(spark, V.hamming(F.lit([0, 1, 1, 3, 4]), F.lit([0, 1, 2, 3, 4]))) == 1
    with pytest.raises(PySparkException, match="not the same length"):
        one(spark, V.hamming(F.lit([0, 1, 1, 3, 4]), F.lit([0, 1, 2, 3])))


def test_cosine_of_zero_is_null(spark):
    assert one(spark, V.cosine(F.lit([0.0, 0.0]), F.lit([1.0, 2.0]))) is None


def test_bits_follow_the_hex_digits(spark):
    import hashlib

    bits = spark.range(1).select(*[b.alias(f"b{i}") for i, b in enumerate(H.token_bits(F.lit("42"), 64))]).first()
    want = bin(int(hashlib.md5(b"42").hexdigest()[:16], 16))[2:].zfill(64)
    assert "".join(str(b) for b in bits) == want


def test_text(spark):
    assert one(spark, X.strip_punct(F.lit("a'b!\"#$%&()*+,-./:;<=>?@[]^_`{|}~\\c"))) == "abc"
    assert one(spark, X.strip_non_ascii(F.lit("naïve – ok"))) == "nave  ok"
    assert one(spark, X.strip_edge_punct(F.lit("(it's)."))) == "it's"
    assert one(spark, X.tokens(F.lit("A  b"), " ")) == ["a", "", "b"]
    assert one(spark, X.tokens(F.lit(" The cat\tsat on "), None, 3)) == ["the", "cat", "sat"]
    assert one(spark, X.extract_ints(F.lit("(107, 13) x7"))) == [107, 13, 7]
    assert [one(spark, X.round_rating(F.lit(v))) for v in (2.5, 3.5, 3.4, 0.5)] == [3, 4, 3, 1]
    assert one(spark, X.from_utf8(X.to_utf8(F.lit("é")))) == "é"


def test_policy_scores_agree(spark):
    for p in P.POLICIES:
        got = one(spark, P.bid_score(p, F.lit(0.4), F.lit(30.0), F.lit(100.0)))
        assert got == pytest.approx(P.local_score(p, 0.4, 30.0, 100.0))


def test_filter_feed(spark):
    rows = [("en", 10.0, 5.0, "I love it"), ("en", 200.0, 5.0, "hate"), ("de", 10.0, 5.0, "love"), ("en", 0.0, 0.0, "glove")]
    df = spark.createDataFrame(rows, "lang string, lon double, lat double, value string")
    assert filter_feed(df, ["en"], box=(-180, -90, 180, 90)).count() == 2
    assert [r.value for r in filter_feed(df, ["en"], track=["love", "hate"]).collect()] == ["I love it", "hate"]
