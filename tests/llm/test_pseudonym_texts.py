"""Pseudonyms in whole texts: every form is found at its place, all else stays, and all can be revealed."""

import random
import time
from datetime import date

import pytest

from sievemark.llm import pseudonyms
from sievemark.llm.pseudonyms import DateForm, Pseudonyms, in_script, plain_digits, replace

FORMS = [
    ("phone", "+١ (٤١٥) ٥٥٥-٢٦٧١"),
    ("ssn", "٠٧٨-٠٥-١١٢٠"),
    ("card", "४१११ ११११ ११११ ११११"),
    ("date", "12/31/1987"),
    ("date", "1/2/1987"),
    ("date", "01/2/1987"),
    ("date", "31.12.1987"),
    ("date", "31 December 1999"),
    ("date", "1 MAY 2001"),
    ("date", "Dec 3, 1999"),
    ("date", "24. Dezember 1999"),
    ("date", "1 août 1999"),
    ("phone", "+14155552671"),
    ("phone", "+4930123456789"),
    ("phone", "5551234567"),
    ("phone", "415-555-2671"),
    ("ip", "2001:db8::8a2e:370:7334"),
    ("ip", "2001:0DB8:0000:0000:0000:8a2e:0370:7334"),
    ("ip", "192.168.10.7"),
    ("secret", "0123456789abcdefABCDEF0123456789abcd"),
    ("email", "müller@büro.example.de"),
    ("email", "иван.7@example.com"),
]
BEFORE = {"0123456789abcdefABCDEF0123456789abcd": "ghp_"}
# None of these is a value.
PLAIN = ["12:30:45", "std::vector", "a::b", "1234567890", "32/13/1999", "v1.2.3", "31 Dezembre 1999", "²³", "٣", "May 2001", ""]


def revealed(text, listed, names):
    for item in listed:
        start, stop = item["start"], item["start"] + item["length"]
        made = text[start:stop]
        text = text[:start] + in_script(names.reveal(item["kind"], plain_digits(made)), made) + text[stop:]
    return text


@pytest.mark.parametrize("seed", range(30))
def test_forms_in_whole_texts(seed):
    rng = random.Random(seed)
    names = Pseudonyms(rng.randbytes(rng.choice([1, 32, 64, 65, 300])))
    text, planted = "", []
    for _ in range(rng.randint(0, 60)):
        if rng.random() < 0.5:
            kind, value = rng.choice(FORMS)
            text += BEFORE.get(value, "")
            planted.append((kind, len(text), len(value)))
            text += value
        else:
            text += rng.choice(PLAIN)
        text += rng.choice([" | ", "\n", " und; ", " — "])
    made, listed = replace(text, names)
    assert [(i["kind"], i["start"], i["length"]) for i in listed] == planted
    assert len(made) == len(text)
    at = 0
    for _, start, length in planted:
        assert made[at:start] == text[at:start]
        assert made[start : start + length] != text[start : start + length]
        at = start + length
    assert made[at:] == text[at:]
    assert revealed(made, listed, names) == text
    # A pseudonym is a value of the same kind.
    assert replace(made, names)[1] == listed


def test_equal_values_are_linked_over_forms():
    names = Pseudonyms(b"key")
    made = [replace(v, names)[0] for v in ("+14155552671", "+1 415-555-2671", "+١ (٤١٥) ٥٥٥-٢٦٧١")]
    assert len({"".join(c for c in plain_digits(m) if c.isdigit()) for m in made}) == 1
    assert replace("1999-12-31", names)[0].split("-") == replace("31.12.1999", names)[0].split(".")[::-1]


def test_dates_of_a_form_are_permuted_among_themselves():
    names = Pseudonyms(b"key")
    years = range(1900, 2100)
    short = [f"{d}/{m}/{y}" for d in range(1, 10) for m in (2,) for y in years]
    made = {names.of("date", v) for v in short}
    assert len(made) == len(short)
    assert all(len(v) == 8 and DateForm.of(v) for v in made)
    american = [f"12/{d}/1987" for d in range(13, 32)]
    assert all(int(names.of("date", v).split("/")[1]) > 12 for v in american)
    assert DateForm.of("13/13/1987") is None and DateForm.of("31/04/1987") is None
    assert DateForm.of("3 Mai 1987").day == date(1987, 5, 3)


def test_long_values_and_many_values_take_time_in_proportion():
    names = Pseudonyms(b"key")
    start = time.perf_counter()
    secret = "token = " + "Ab9" * 100_000
    made, listed = replace(secret, names)
    assert len(made) == len(secret) and listed[0]["length"] == 300_000
    assert revealed(made, listed, names) == secret
    many = " ".join(f"user{i}@example.com 415-555-{i % 10_000:04d}" for i in range(10_000))
    made, listed = replace(many, names)
    assert len(listed) == 20_000
    assert time.perf_counter() - start < 60


def test_a_key_is_needed():
    with pytest.raises(ValueError):
        Pseudonyms(b"")
    assert pseudonyms.replace("no values", Pseudonyms(b"k")) == ("no values", [])
