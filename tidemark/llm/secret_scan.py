"""Secret scans: credential patterns, and guess costs of values in credential contexts.

Base patterns find assignments, access keys and long hex runs.  Beyond them, a
value in a credential context that base spans do not cover to its end is priced
whole by dynamic programming: the cheapest segmentation of the value into words,
dates, repeats, keyboard walks and brute-force spans.  A value that is costly to
guess is a secret; a placeholder or a weak word is not.  A word costs its rank in
a vocabulary of public text, an unknown character the size of the alphabet that
the value draws on.  After the verb ``is`` stands prose as often as a value, so
there a value must look like one.

Defined results: a null or empty text has no spans; texts are scanned whole, in
time that grows with their length; repeated rows each get their spans; other
columns pass through untouched.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Callable, Iterator, Mapping
from functools import cache, lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base patterns, in their order
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

# credential contexts of the priced values: a name, a sign or verb, and what stands up to white space or a quote
CONTEXT = re.compile(
    r"""\b(?:password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|credentials?|private[_-]?key)["']?"""
    r"""[\x20\t]*(:=|=>|[:=]|\bis\b)[\x20\t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'<>]+))""",
    re.I | re.A,
)
# after "is": signs that prose does not have inside a word, and what joins words of prose
TELLING = re.compile(r"""[!#$%^&*+=@~|\\?_`{}\[\]]""")
JOINED = re.compile(r"[-/'.,:;()]+")
ADDRESS = re.compile(r"^(?:[a-z][a-z0-9+.-]*://\S+|[\w.+-]+@[\w-]+(?:\.[\w-]+)+)$", re.I | re.A)
# the same values where only the base pattern knows the name, as in db_password
QUOTED = {'"': re.compile(r'([^"\n]+)"'), "'": re.compile(r"([^'\n]+)'")}
BARE = re.compile(r"""[^\s"'<>]+""", re.A)
PLACEHOLDER = re.compile(r"^(?:\$\{.*\}|\$\(.*\)|\{\{.*\}\}|%\w+%|<.*>|\[.*\]|\*+|x+|\.+|n/?a|null|none|true|false)[.,;)]*$", re.I)

# fixed values: words that many passwords are, by rank
WORDS = (
    "password", "admin", "welcome", "login", "master", "dragon", "monkey", "shadow", "sunshine", "princess",
    "letmein", "football", "baseball", "iloveyou", "trustno", "superman", "batman", "secret", "default", "changeme",
    "change", "guest", "root", "user", "test", "example", "sample", "dummy", "demo", "temp",
    "hello", "freedom", "whatever", "summer", "winter", "spring", "autumn", "monday", "friday", "january",
    "august", "december", "london", "berlin", "paris", "madrid", "love", "angel", "money", "computer",
    "internet", "server", "system", "token", "access", "private", "public", "company", "here", "your",
    "this", "that", "insert", "replace", "value", "string", "not", "the", "key", "my",
)
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("@430157$!", "aaeoist" + "si")
_MONTH, _DAY, _YEAR = "(?:1[0-2]|0?[1-9])", r"(?:3[01]|[12]\d|0?[1-9])", r"(?:19|20)\d\d"
_DATE = re.compile(f"{_YEAR}[-/._]?{_MONTH}[-/._]?{_DAY}|{_DAY}[-/._]?{_MONTH}[-/._]?{_YEAR}|{_YEAR}")
# the longest unit of a repeat
REPEAT_UNIT = 8
# log10 of the guesses for trying one more segment
PER_SEGMENT = math.log10(2)
# what LEAST_VALUE unknown digits cost, so that no value is too short to be a secret
LEAST_LOG_GUESSES = float(LEAST_VALUE)
# values up to this length are priced once per task
_CACHED = 200


@cache
def public_words(file: str = "byte_bpe_50k.tiktoken") -> Mapping[str, int]:
    """Words of three letters or more, and short numbers, by their rank in a public vocabulary; the fixed words first.

    The vocabulary lists pieces of text by how often they are merged; pieces that
    begin with a blank begin a word.  The file is found where the task runs.
    """
    ranks = {word: rank for rank, word in enumerate(WORDS, 1)}
    with open(public_tokenizers.path(file), "rb") as lines:
        for line in lines:
            piece, rank = line.split()
            word = base64.b64decode(piece).decode("utf-8", "replace")
            core = word[1:].lower()
            if word[:1] == " " and ((core.isalpha() and len(core) >= 3) or (core.isdigit() and 2 <= len(core) <= 4)):
                ranks.setdefault(core, int(rank) + 1)
    return ranks


@cache
def _beginnings(words: Callable[[], Mapping[str, int]]) -> tuple[Mapping[str, int], frozenset[str], int]:
    """The words' ranks, their first two characters, and the longest one's length."""
    ranks = words()
    return ranks, frozenset(w[:2] for w in ranks), max(map(len, ranks), default=0)


def per_character(value: str) -> float:
    """log10 of the guesses for one unknown character: the alphabets that the value draws on."""
    size = 26 * bool(re.search("[a-z]", value)) + 26 * bool(re.search("[A-Z]", value)) + 10 * bool(re.search("[0-9]", value))
    size += 33 * bool(re.search(r"[\x00-\x7F](?<![A-Za-z0-9])", value)) + 100 * (not value.isascii())
    return math.log10(max(size, 2))


def _places() -> dict[str, tuple[int, int]]:
    return {c: (row, column) for row, keys in enumerate(KEYBOARD) for column, c in enumerate(keys)}


_PLACE = _places()


def _next_to(a: str, b: str) -> bool:
    p, q = _PLACE.get(a), _PLACE.get(b)
    if p is None or q is None:
        return False
    # rows are shifted, so a key touches two keys of the next row
    return (p[0] == q[0] and abs(p[1] - q[1]) == 1) or (q[0] - p[0] == 1 and q[1] - p[1] in (-1, 0)) or (
        p[0] - q[0] == 1 and p[1] - q[1] in (-1, 0)
    )


def _repeats(value: str) -> list[tuple[int, int]]:
    """Per position the end of the longest repeat of the shortest unit that begins there, and the unit's length."""
    n = len(value)
    found = [(0, 0)] * n
    for unit in range(REPEAT_UNIT, 0, -1):
        run = 0
        for i in range(n - unit - 1, -1, -1):
            run = run + 1 if value[i] == value[i + unit] else 0
            if run >= unit and (length := unit * (run // unit + 1)) >= 3:
                found[i] = (i + length, unit)
    return found


def _walks(lower: str) -> dict[int, int]:
    """Where keyboard walks of three keys or more begin, and where the longest ends."""
    found, start, n = {}, 0, len(lower)
    while start < n - 1:
        end = start + 1
        while end < n and _next_to(lower[end - 1], lower[end]):
            end += 1
        if end - start >= 3:
            found[start] = end
        start = max(end - 1, start + 1)
    return found


def segments(value: str, words: Callable[[], Mapping[str, int]] = public_words) -> Iterator[tuple[int, int, float, str]]:
    """Every span of ``value`` that some cheap guess covers, by start: start, end, log10 guesses, kind."""
    ranks, beginnings, longest = _beginnings(words)
    lower, n, each = value.lower(), len(value), per_character(value)
    if len(lower) != n:
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = lower.translate(LEET)
    repeats, walks = _repeats(value), _walks(lower)
    for start in range(n):
        # as it is written, and with its digits and signs read as letters
        for spelled in {lower, plain} if lower[start : start + longest] != plain[start : start + longest] else (lower,):
            if spelled[start : start + 2] not in beginnings:
                continue
            for end in range(start + 2, min(n, start + longest) + 1):
                rank = ranks.get(spelled[start:end])
                if rank:
                    capitals = sum(c.isupper() for c in value[start:end])
                    variants = 1 if not capitals else 2 if capitals in (1, end - start) else 2**capitals
                    variants *= 2 ** sum(a != b for a, b in zip(spelled[start:end], lower[start:end], strict=True))
                    yield start, end, math.log10(rank * variants), "word"
        if lower[start].isdigit() and (date := _DATE.match(value, start)):
            yield start, date.end(), math.log10(365 * 60 if date.end() - start > 4 else 60), "date"
        end, unit = repeats[start]
        if end:
            yield start, end, unit * each + math.log10((end - start) / unit), "repeat"
        for stop in range(start + 3, walks.get(start, 0) + 1):
            yield start, stop, math.log10(len(_PLACE) * 4 * (stop - start)), "walk"


def guess_cost(value: str, words: Callable[[], Mapping[str, int]] = public_words) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the guesses of the cheapest segmentation of ``value``, and its segments.

    Two costs per position: all before it is segmented (``done``), or the last
    segment is an open brute-force span.  Every other segment starts at a
    ``done`` position and is tried as soon as that is known, so time grows with
    the number of segments and memory with the value.
    """
    n, each = len(value), per_character(value)
    done, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    how: list[tuple[int, str]] = [(0, "")] * (n + 1)
    begun, cheap, ahead = [0] * (n + 1), segments(value, words), None
    for at in range(n + 1):
        if at:
            opened, longer = done[at - 1] + PER_SEGMENT * (at > 1), brute[at - 1]
            begun[at] = at - 1 if opened <= longer else begun[at - 1]
            brute[at] = min(opened, longer) + each
            if brute[at] < done[at]:
                done[at], how[at] = brute[at], (begun[at], "brute")
        while ahead is not None or (ahead := next(cheap, None)):
            start, end, cost, kind = ahead
            if start > at:
                break
            total = done[at] + PER_SEGMENT * (at > 0) + cost
            if total < done[end]:
                done[end], how[end] = total, (at, kind)
            ahead = None
    path, at = [], n
    while at > 0:
        start, kind = how[at]
        path.append((start, at, kind))
        at = start
    return done[-1], path[::-1]


_short_cost = lru_cache(maxsize=20_000)(lambda value, words: guess_cost(value, words))


def _priced(value: str, words: Callable[[], Mapping[str, int]]) -> tuple[float, list[tuple[int, int, str]]]:
    return (_short_cost if len(value) <= _CACHED else guess_cost)(value, words)


def _looks_like_a_value(value: str, words: Callable[[], Mapping[str, int]]) -> bool:
    """Whether what follows ``is`` is no word of a sentence."""
    if TELLING.search(value):
        return True
    if not re.search(r"[0-9]|[a-z][A-Z]", value):
        return False
    ranks, parts = words(), [p.lower() for p in JOINED.split(value) if p]
    known = [p in ranks or p.isdigit() for p in parts]
    return not all(known) and not any(k and len(p) >= 4 and p.isalpha() for k, p in zip(known, parts, strict=True))


def _bare(value: str, start: int, also: str = "") -> tuple[int, int]:
    return start, start + len(value.rstrip(".,;)" + also))


def context_values(text: str, assigned: list[re.Match]) -> list[tuple[int, int, bool]]:
    """Start and end of the values in credential contexts, those of the base pattern's names to their ends, and whether prose may stand there."""
    found = set()
    for m in CONTEXT.finditer(text):
        group, verb = m.lastindex, m[1].lower() == "is"
        if group == 4:
            found.add((*_bare(m[group], m.start(group), "!?:" if verb else ""), verb))
        else:
            found.add((*m.span(group), False))
    for m in assigned:
        start = m.start(2)
        quoted = QUOTED[text[start - 1]].match(text, start) if text[start - 1] in QUOTED else None
        found.add((*(quoted.span(1) if quoted else _bare(BARE.match(text, start)[0], start)), False))
    return sorted(found)


def _covered(start: int, end: int, spans: list[tuple]) -> bool:
    """Whether ``spans``, by start, cover everything from ``start`` to ``end``."""
    for s, e, *_ in spans:
        if s > start:
            break
        start = max(start, e)
    return start >= end


def find_spans(text: str, words: Callable[[], Mapping[str, int]] = public_words, price_base: bool = False) -> list[tuple[int, int, str, float | None]]:
    """Start, end, kind and log10 guesses of all secrets, by start and then kind; base spans are priced on request."""
    spans: list[tuple[int, int, str, float | None]] = []
    assigned = list(ASSIGN.finditer(text))
    for m in assigned:
        if m.end(2) - m.start(2) >= LEAST_VALUE:
            spans.append((m.start(), m.end(), "assign", _priced(m[2], words)[0] if price_base else None))
    spans += [(m.start(), m.end(), "access", None) for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex", None) for m in HEX.finditer(text)]
    base = sorted(spans, key=lambda s: s[0])
    for start, end, prose in context_values(text, assigned):
        value = text[start:end]
        if len(value) < LEAST_VALUE or PLACEHOLDER.match(value) or ADDRESS.match(value) or _covered(start, end, base):
            continue
        cost, _ = _priced(value, words)
        if cost >= LEAST_LOG_GUESSES and (not prose or _looks_like_a_value(value, words)):
            spans.append((start, end, "guess", cost))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redact(text: str, mark: str = "[SECRET]") -> str:
    """``text`` with every secret replaced; overlapping spans become one mark."""
    out, at = [], 0
    for start, end, *_ in find_spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("log_guesses", pa.float64())])


def spans_of(text: Column) -> Column:
    """``array<struct<start, end, kind, log_guesses>>`` of a text column; empty for null, unpriced for base spans."""

    @F.arrow_udf("array<struct<start:bigint,end:bigint,kind:string,log_guesses:double>>")
    def scan(texts: pa.Array) -> pa.Array:
        names = ("start", "end", "kind", "log_guesses")
        rows = [[dict(zip(names, s, strict=True)) for s in find_spans(t.as_py() or "")] for t in texts]
        return pa.array(rows, pa.list_(_SPAN))

    return scan(text)


def redacted(text: Column) -> Column:
    """The text with its secrets replaced; null stays null."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([None if (t := x.as_py()) is None else redact(t) for x in texts], pa.string())

    return clean(text)


def redacted_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with secrets replaced; every document stays, its character count follows its text."""
    cleaned = docs.withColumn(text, redacted(F.col(text)))
    if "n_chars" in docs.columns:
        counted = F.coalesce(F.length(text).cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", counted)
    return cleaned.select(*docs.columns)
