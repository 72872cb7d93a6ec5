import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veclode.functions.hashing import string_hash, term_index
from veclode.functions.text import (
    between_tags,
    clean_title,
    keep_lines,
    last_record,
    mail_body,
    tokens,
)
from veclode.operators.terms import string_hashes


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("r")).head()["r"]


def test_mail_body_keeps_only_body_lines(spark):
    mail = "Message-ID: <1>\nSubject: hi\r\nTomorrow we go\nhello world\nx\n\nX-FileName: a\nsubject too\r😀"
    assert one(spark, keep_lines(F.col("t")), t=mail) == "hello world subject too 😀 "


def test_strict_headers_need_the_colon(spark):
    strict = keep_lines(F.col("t"), lambda line: mail_body(line, strict=True))
    assert one(spark, strict, t="To: you\nTomorrow we go") == "Tomorrow we go "


def test_predicate_can_be_any_expression(spark):
    long_lines = keep_lines(F.col("t"), lambda line: F.length(line) > 3)
    assert one(spark, long_lines, t="abcd\nab\nefghi") == "abcd efghi "


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a  b ", ["a", "", "b"]),
        (" a b", ["", "a", "b"]),
        ("", [""]),
        ("   ", []),
        ("one", ["one"]),
    ],
)
def test_tokens(spark, text, expected):
    assert one(spark, tokens(F.col("t")), t=text) == expected
    dropped = one(spark, tokens(F.col("t"), keep_empty=False), t=text)
    assert dropped == [w for w in expected if w]


def test_titles(spark):
    assert one(spark, clean_title(F.col("t")), t="On <i>Foo</i> Bar.") == "on <i>foo</i> bar"
    assert one(spark, clean_title(F.col("t")), t="What..") == "what."
    assert one(spark, between_tags(F.col("t"), "year"), t="<year>2008</year>") == "2008"
    assert one(spark, between_tags(F.col("t"), "year"), t="<years>2008</years>") is None


def test_last_record_skips_what_stands_before(spark):
    text = "<book><title>x</title></book>\n<article key='a'><title>y</title>"
    assert one(spark, last_record(F.col("t"), "article"), t=text).startswith("<article key='a'>")
    assert one(spark, last_record(F.col("t"), "article"), t="<articles>") is None


def jvm_hash(word):
    h = 0
    data = word.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


WORDS = ["", "a", "hello", "Überlänge", "日本語", "a😀b", "polygenelubricants", "x" * 500, ""]


def test_string_hashes_of_a_batch():
    batch = pa.array(WORDS)
    assert string_hashes(batch).tolist() == [jvm_hash(w) for w in WORDS]
    assert string_hashes(batch[3:6]).tolist() == [jvm_hash(w) for w in WORDS[3:6]]
    assert string_hashes(pa.array(["", ""])).tolist() == [0, 0]
    assert string_hashes(batch[:0]).tolist() == []
    broken = pa.array([b"ok", b"b\xffd"]).view(pa.string())
    assert string_hashes(broken).tolist() == [jvm_hash("ok"), jvm_hash("b\ufffdd")]


def test_string_hash(spark):
    words = WORDS
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select("w", string_hash(F.col("w")).alias("h"), term_index(F.col("w"), 97).alias("i"))
    for r in rows.collect():
        assert r["h"] == jvm_hash(r["w"])
        assert r["i"] == jvm_hash(r["w"]) % 97
