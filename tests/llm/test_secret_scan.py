"""Prose stays untouched, random values are found, long runs take linear time."""

import itertools
import random
import string
import time

import pytest

from tidemark.llm import secret_scan

NAMES = ("password", "The token", "Your secret", "This passphrase", "The API key", "A passcode")
# what sentences say of passwords and tokens
SAID = (
    "required to log in", "expired today", "something you choose", "always encrypted", "not stored anywhere", "case-sensitive", "well-known",
    "up-to-date", "base64-encoded", "user-specific", "invalid or missing", "wrong!", "correct?", "stored in /etc/shadow", "hashed with SHA-256 first",
    "SHA-256 hashed", "AES-256 encrypted", "at least 12 characters long", "too short", "twenty-four characters", "a one-time code", "kept under lock and key",
    "revoked immediately", "renewed every 90 days", "sent to user@example.com", "user@example.com for everyone", "https://example.com/reset", "rotated weekly",
    "self-signed", "unguessable", "pseudonymous", "irretrievable", "yesterday's news", "nobody's business", "company-wide", "machine-generated",
    "cryptographically strong", "printed on the box", "documented elsewhere", "deprecated since 2019-03-01", "available on request", "confidential",
    "shared between colleagues", "everybody's responsibility", "transmitted in plaintext", "autogenerated", "longer than necessary", "misspelled",
    "re-issued on Monday", "country-dependent", "either/or", "read-only", "(optional)", "mandatory.", "obsolete;", "considered harmful", "checked twice",
    "regenerated nightly", "unchanged", "whitespace-sensitive", "context-dependent", "JWT-formatted", "provided by the administrator", "somewhere safe",
    "e-mailed separately", "20-30 characters", "four-digit", "typically numeric", "entirely random", "never displayed", "worthless without the username",
    "embedded in firmware", "long-lived", "short-lived", "tamper-proof", "bound to the device", "retrievable via settings", "synchronised hourly",
    "overwritten afterwards", "visible to moderators", "encrypted-at-rest", "non-transferable", "single-use", "hard-coded", "memorable", "pronounceable",
)


def test_everyday_sentences_have_no_secret():
    sentences = [f"{name} is {said}" for name, said in itertools.product(NAMES, SAID)]
    assert len(sentences) >= 500
    assert [s for s in sentences if secret_scan.find_spans(s) or secret_scan.redact(s) != s] == []


def test_sentences_of_the_corpus_stay():
    for text in ("your password is required to log in", "token is expired today", "password is something you choose", "A secret is Rosebud to many"):
        assert secret_scan.redact(text) == text


@pytest.mark.parametrize("context", ["pwd={}", "passcode: {}", "my passphrase is {}", 'credentials = "{}"', "password: {}#!", "private_key => '{}'"])
def test_random_values_are_found(context):
    rng, missed = random.Random(7), []
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "!#$%&*+@_", string.digits + string.ascii_lowercase)
    for alphabet, length in itertools.product(alphabets, range(6, 20)):
        for _ in range(20):
            value = "".join(rng.choice(alphabet) for _ in range(length))
            if " is " in context and not (any(c.isdigit() for c in value[1:-1]) or any(c in "!#$%&*+@_" for c in value[1:-1])):
                continue
            text = context.format(value) + " end"
            if not any(text[s:e].strip("\"'").find(value.rstrip("!?")) >= 0 or text.find(value) >= s for s, e, *_ in secret_scan.find_spans(text)):
                missed.append(value)
    assert missed == []


def test_digits_of_six_places_are_found():
    assert [s[2] for s in secret_scan.find_spans("passcode: 483920")] == ["guess"]
    assert secret_scan.find_spans("passcode: 222222") == [] and secret_scan.find_spans("passcode: 19991231") == []


@pytest.mark.parametrize("run", ["a", "ab", "abcdefgh", "asasqw", "password", "1", "x!9Q"])
def test_long_values_take_seconds(run):
    started = time.monotonic()
    value = run * (200_000 // len(run))
    cost, path = secret_scan.guess_cost(value)
    assert path[-1][1] == len(value) and cost < 40
    assert len([s for s in secret_scan.find_spans(f"pwd={value}!") if s[2] == "guess"]) <= 1
    assert time.monotonic() - started < 20


def test_costs_follow_alphabet_and_rank():
    per = secret_scan.per_character
    assert per("123") == 1 and per("abc") < per("abC") < per("ab1C") < per("ab1C!") < per("ab1C!é")
    cost = lambda v: secret_scan.guess_cost(v)[0]
    assert cost("password") < cost("something") < cost("correcthorse") < cost("xqzvkwpj")
    assert cost("p4ssword") > cost("password") and cost("Password") > cost("password")
    assert secret_scan.guess_cost("") == (0.0, [])


def test_base_spans_are_priced_on_request():
    text = "password=Xk9pQ2vR7mZ4"
    assert secret_scan.find_spans(text)[0][3] is None and secret_scan.find_spans(text, price_base=True)[0][3] > 6
