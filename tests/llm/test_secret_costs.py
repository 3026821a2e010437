"""Guess costs against all segmentations, base spans against a plain scan, and long texts."""

import math
import random
import re
import time

import pytest

from kairoline.llm import secrets

R = random.Random(11)
BITS = ["a", "b", "1", "abc", "qwe", "pass", "Pass", "2021", "12", "p@ss", "xX", "$", "red", "aaa"]


def explained(value: str, a: int, b: int) -> float:
    """Cheapest single explanation of a stretch, each kind tried by its definition."""
    part = value[a:b]
    low, plain = part.lower(), part.lower().translate(str.maketrans("4@30$51!7", "aaeossilt"))
    size = {c: math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33) for c in part}
    found = [sum(size[c] for c in part)]
    rank = {}
    for i, w in enumerate(secrets.WORDS):
        rank.setdefault(w, i + 1)
    case = 1 if part == low else 2
    if low in rank:
        found.append(math.log10(rank[low] * case))
    elif plain in rank:
        found.append(math.log10(rank[plain] * case * 4))
    for period in range(1, 9):
        if len(part) >= max(2 * period, 3) and not (a and value[a - 1] == value[a - 1 + period]) and all(part[k] == part[k - period] for k in range(period, len(part))):
            found.append(sum(size[c] for c in part[:period]) + math.log10(len(part) / period))
    if len(part) >= 3 and all(b in secrets._NEXT.get(a, ()) for a, b in zip(low, low[1:], strict=False)):
        found.append(math.log10(47 * 5) + (len(part) - 1) * math.log10(2))
    return min(found)


def test_costs_equal_the_best_of_all_segmentations():
    for _ in range(400):
        value = "".join(R.choice(BITS) for _ in range(R.randint(1, 5)))[:9]
        if re.search(r"\d{4}", value):
            continue  # dates have cases of their own
        best = math.inf
        for cuts in range(1 << (len(value) - 1)):
            ends = [k + 1 for k in range(len(value) - 1) if cuts >> k & 1]
            best = min(best, len(ends) * math.log10(2) + sum(
                explained(value, a, b) for a, b in zip([0, *ends], [*ends, len(value)], strict=True)))
        assert secrets.guess_cost(value) == pytest.approx(best), value


def test_base_spans_equal_a_plain_scan():
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    bits = ["token", "API_key", "Secret", "=", ": ", '"', "AKIA", "Z9Q8W7E6R5T4Y3U2", "0123456789abcdef", " ", "\n", "ſecret", "K", "é"]
    for _ in range(3000):
        t = "".join(R.choice(bits) for _ in range(R.randint(1, 14)))
        want = [("assign", *m.span()) for m in re.finditer(assign, t, re.I | re.A) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        got = [s[:3] for s in secrets.find(t) if s[0] != "guess"]
        assert sorted(got) == sorted(want), t


@pytest.mark.parametrize("text", [
    "token" * 200_000, "Ab3" * 333_333 + "://x", "password = " + "".join(R.choices("abcXYZ012$!", k=1_000_000)),
    "-" * 1_000_000 + "=", "token " + " " * 1_000_000, "bearer " * 140_000], ids=["names", "url", "value", "dashes", "spaces", "headers"])
def test_long_texts_take_linear_time(text):
    start = time.process_time()
    secrets.find(text)
    assert time.process_time() - start < 8


def test_keys_at_the_end_of_a_value_have_their_own():
    value = "Zx9$Lm2!kQ7@vR4"
    assert [t[a:b] for t in (f"auth: token: {value}", f"x-auth=token:{value}") for k, a, b, _ in secrets.find(t) if k == "guess"][0] == value
    assert [s[0] for s in secrets.find("token=token=token=token=")] == ["assign"]
