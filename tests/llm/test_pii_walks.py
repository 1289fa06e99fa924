"""Pseudonyms over every date, social-security rules and adversarial texts."""

import datetime
import random
import time

import pytest

from millrace.llm import mixing, pii
from tests.llm.test_pii_and_tokens import luhn, replaced


def test_every_date_turns_back(spark):
    first = datetime.date(1900, 1, 1)
    days = [str(first + datetime.timedelta(n)) for n in range(73_049)]
    assert days[-1] == "2099-12-31"
    texts = [" ".join(days[k:k + 50]) for k in range(0, len(days), 50)]
    got = replaced(spark, texts)
    new = " ".join(got).split()
    assert sorted(new) == days and replaced(spark, got, back=True) == texts


def test_social_security_numbers(spark):
    rng = random.Random(3)
    bad = ["000-12-3456", "666-12-3456", "900-12-3456", "987-65-4321", "123-00-4567", "123-45-0000"]
    good = list(dict.fromkeys(f"{rng.choice([1, 665, 667, 899, rng.randint(1, 665)]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}" for _ in range(300)))
    assert replaced(spark, bad) == bad
    got = replaced(spark, good)
    assert len(set(got)) == len(good) and replaced(spark, got, back=True) == good
    for n in got:
        a, b, c = n.split("-")
        assert a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


def test_other_ways_to_write(spark):
    calls = [f"call ({n:03d}) 555-0199 now" for n in range(200, 260)]
    assert replaced(spark, replaced(spark, calls), back=True) == calls
    texts = ["PASSWORD=Secret1 x", "password: Secret1 x", "Password = Secret1 x", "call (202) 555-0199 now"]
    got = replaced(spark, texts)
    token = {g.split()[-2].split("=")[-1] for g in got[:3]}
    assert len(token) == 1 and "Secret1" not in "".join(got)
    assert got[0].startswith("PASSWORD=") and got[1].startswith("password: ") and got[2].startswith("Password = ")
    assert got[3] != texts[3] and replaced(spark, got, back=True)[3] == texts[3]


@pytest.mark.parametrize("text", [
    "a@" + "b." * 200_000, "a@" + "b." * 20_000 + "com", "a." * 500_000 + " @ password=", "@" * 1_000_000, "1" * 1_000_000,
    " " * 1_000_000 + "@", "a@b" * 300_000, "+" * 1_000_000 + "@", "password" * 120_000 + "=", "1." * 500_000, "(202) " * 160_000, "-" * 1_000_000 + "12345678",
], ids=range(12))
def test_adversarial_texts(spark, text):
    replaced(spark, ["warm up a@b.com"])
    began = time.time()
    got = replaced(spark, [text])[0]
    assert time.time() - began < 15 and len(got) > len(text) // 2


def test_key_is_not_in_the_plan(spark):
    frame = spark.createDataFrame([(1, "a 2020-01-01")], "doc_id long, text string")
    out = pii.pseudonymised(frame, "hush-hush-key")
    out.collect()
    assert "hush" not in out._jdf.queryExecution().toString()


def test_words_of_a_megabyte_of_blanks(spark):
    texts = [" " * 1_000_000, "a" + " " * 1_000_000 + "b", None, "", " a", "a ", "\t\x0b\r\n", "a b c", "x" * 100]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    began = time.time()
    got = [r[0] for r in frame.select(mixing.words(frame.text)).collect()]
    assert got == [0, 2, 0, 0, 1, 1, 0, 2, 1] and time.time() - began < 5


def test_equal_rows_without_ids_are_spread(spark):
    rows = spark.range(20_000).selectExpr("cast(null as long) doc_id", "cast(null as string) text", "'s' source", "1 tag")
    tags = mixing._numbered(rows, 3).select("tag").distinct().count()
    assert tags == 20_000
    out = mixing.mixed_documents(rows).collect()
    assert len(out) == 20_000 and {r.taken for r in out} == {0}
    same = spark.range(9_000).selectExpr("cast(null as long) doc_id", "'a b' text", "'s' source")
    assert sum(r.taken for r in mixing.mixed_documents(same).collect()) == 18_000


def test_luhn_helper():
    assert luhn("4111111111111111") == 0
