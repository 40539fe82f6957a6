"""Pseudonyms against a finder that tries every start and every end of dense
random texts, each check written for itself: no valid value stays in clear."""

import datetime
import random

import pytest

from candlewick.llm import pseudonyms


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        d *= 1 + i % 2
        total += d if d < 10 else d - 9
    return total % 10 == 0


def is_card(s):
    """13 to 19 digits, single blanks or hyphens between some."""
    plain = s.replace(" ", "").replace("-", "")
    single = all(not (a in " -" and b in " -") for a, b in zip(s, s[1:]))
    return plain.isdigit() and s[0].isdigit() and s[-1].isdigit() and single and 13 <= len(plain) <= 19 and len(set(plain)) > 1 and luhn(plain)


def is_iban(s):
    """Two letters, two digits, groups of four, the last may be shorter."""
    plain, groups = s.replace(" ", ""), s.split(" ")
    if not 15 <= len(plain) <= 34 or not (plain[:2].isalpha() and plain[2:4].isdigit()) or not all(c.isdigit() or "A" <= c <= "Z" for c in plain):
        return False
    if len(groups) > 1 and (any(len(g) != 4 for g in groups[:-1]) or not 1 <= len(groups[-1]) <= 4):
        return False
    number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
    return 2 <= int(plain[2:4]) <= 98 and int(number) % 97 == 1


def is_ssn(s):
    parts = s.split("-")
    if [len(p) for p in parts] != [3, 2, 4] or not all(p.isdigit() for p in parts):
        return False
    return 0 < int(parts[0]) < 900 and parts[0] != "666" and int(parts[1]) > 0 and int(parts[2]) > 0


def is_date(s):
    try:
        return len(s) == 10 and 1900 <= datetime.date.fromisoformat(s).year < 2100
    except ValueError:
        return False


def spans(text):
    """Every valid span that no letter or digit (a date or number: no digit with
    its separator either) continues."""
    for i in range(len(text)):
        before = text[i - 1] if i else " "
        for j in range(i + 10, min(len(text), i + 45) + 1):
            s, after, more = text[i:j], text[j : j + 1] or " ", text[j : j + 2]
            joined = len(more) == 2 and more[0] in "-./" and more[1].isdigit()
            if not before.isdigit() and not after.isdigit() and is_card(s):
                yield "card", i, j
            if not before.isalnum() and not after.isalnum() and is_iban(s):
                yield "iban", i, j
            if not (before.isdigit() or before in "-./") and not after.isdigit() and not joined and (is_ssn(s) or is_date(s)):
                yield "number", i, j


def token(rng):
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kind = rng.randrange(9)
    if kind == 0:
        body = digits(15)
        return body + str(next(d for d in range(10) if luhn(body + str(d))))
    if kind == 1:
        body = digits(15)
        whole = body + str(next(d for d in range(10) if luhn(body + str(d))))
        return rng.choice(" -").join(whole[k : k + 4] for k in range(0, 16, 4))
    if kind == 2:
        body = digits(18)
        check = 98 - int("".join(str(int(c, 36)) for c in body + "DE00")) % 97
        plain = f"DE{check:02d}{body}"
        return plain if rng.random() < 0.5 else " ".join(plain[k : k + 4] for k in range(0, 22, 4))
    if kind == 3:
        return f"{rng.randrange(1, 899):03d}-{rng.randrange(1, 99):02d}-{rng.randrange(1, 9999):04d}"
    if kind == 4:
        return datetime.date.fromordinal(rng.randrange(700_000, 760_000)).isoformat()
    return rng.choice([digits(rng.randrange(1, 7)), rng.choice("ABCXYZ") * rng.randrange(1, 5), "word", "BIC", "12/25"])


@pytest.mark.parametrize("seed", range(12))
def test_no_valid_value_stays_in_clear(seed):
    rng, found = random.Random(seed), 0
    tool = pseudonyms.Pseudonymiser(f"key{seed}")
    for _ in range(40):
        text = " ".join(token(rng) for _ in range(rng.randrange(2, 9)))
        new, counts = tool.rewrite(text)
        assert len(new) == len(text) and tool.rewrite(new, back=True)[0] == text
        for kind, i, j in spans(text):
            found += 1
            assert new[i:j] != text[i:j], (kind, text[i:j], text, new)
        if not any(True for _ in spans(text)) and not any(counts.get(k) for k in ("phone",)):
            assert new == text
    assert found > 40


def test_long_texts_with_values(tmp_path):
    """A value far inside a long text, and a long text of nothing but values."""
    rng, tool = random.Random(77), pseudonyms.Pseudonymiser("k")
    filler = "lorem ipsum dolor " * 20_000
    values = [token(random.Random(s)) for s in range(300)]
    for text in (filler + "4111 1111 1111 1111" + filler, ", ".join(values)):
        new, _ = tool.rewrite(text)
        assert tool.rewrite(new, back=True)[0] == text and len(new) == len(text)
    assert "4111 1111 1111 1111" not in tool.rewrite(filler + "4111 1111 1111 1111" + filler)[0]
