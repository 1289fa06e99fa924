import random
import re

from tests.llm.test_pii_and_tokens import luhn, replaced

CARD = "4111 1111 1111 1111"


def test_cards_beside_other_digits(spark):
    texts = [f"{CARD} 123", "4111-1111-1111-1111 12/25", "no 7 4111111111111111", f"12 34 56 {CARD} 7", f"5 2024-05-06 {CARD} 1",
             f"{CARD} 5500-0000-0000-0004 99", "3782 822463 10005 1234", f"9 123-45-6789 {CARD}", "41111111 11111111 12/25"]
    got = replaced(spark, texts)
    for old, new in zip(texts, got):
        assert re.sub(r"\d", "9", old) == re.sub(r"\d", "9", new)
        assert not any(v in re.sub(r"[ -]", "", new) for v in ("4111111111111111", "5500000000000004", "378282246310005"))
        assert "2024-05-06" not in new and "123-45-6789" not in new
    assert replaced(spark, got, back=True) == texts


def test_runs_turn_back(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(300):
        d = "".join(rng.choice("0123456789") for _ in range(15))
        card = next(d + c for c in "0123456789" if luhn(d + c) == 0)
        blank = rng.choice([" ", "-", ""])
        card = blank.join(card[k:k + 4] for k in range(0, 16, 4))
        more = lambda: " ".join(str(rng.randrange(10 ** rng.randint(1, 6))) for _ in range(rng.randint(0, 3)))
        texts.append(f"{more()} {card} {more()}")
    got = replaced(spark, texts)
    assert all(a != b and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", b) for a, b in zip(texts, got))
    assert replaced(spark, got, back=True) == texts


def test_long_digits_are_no_card_and_numeric_passwords_go(spark):
    long = "41111111111111111234567"
    assert replaced(spark, [long]) == [long]
    got = replaced(spark, ["password=1234567890123 x", "password=41111111111111111234567"])
    assert all(re.match(r"password=[0-9a-f]{16}\b", g) for g in got)
