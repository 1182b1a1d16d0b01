"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

Base kinds are found leftmost and non-overlapping, each kind by itself; matches that are too short
are dropped after matching. The method adds kind ``guess``: values that follow a credential word and
a colon or equals sign, and whose cheapest explanation takes at least 10**10 guesses. Guesses alone decide, whatever
characters a value is made of. A guess span is the value itself; it may lie in a base span, or overlap one. Plain web addresses (without a user part) are places and no secrets.

The cheapest explanation (``Guesser.cost``) is a dynamic program over segments, whose costs (log10 of guesses) add up:

* a character that nothing explains: 1;
* a word: its rank in the dictionary, in either case, or with digits and signs for letters. The dictionary is the words of a public vocabulary in its order, which follows
  how often they occur, after a few words that are typical of passwords;
* a date or a year;
* a unit of any length that repeats: the unit's own cheapest explanation, and the number of times;
* a walk over neighbouring keys (all directions of a keyboard, and the alphabet): a first key, the length, and each turn.

Every end of every segment is tried, so the cost is the minimum over all segmentations. Two rules are part of the cost: a unit longer than UNIT isn't a
repeat itself, and over TIMES repeats cost no more than TIMES. A scan stops where all that is open
costs 10**10 guesses already, so that long values of no structure are no more work than short ones; what is reported then is a lower bound that is at least 10.

Null text: as empty, which has no spans. Texts of any length are read whole. Repeated rows and equal texts have equal results. Ties: a word's rank is that of its first place.
An empty table gives no rows. Only ``doc_id`` and ``text`` are read for a scan; ``redact`` keeps all columns, and counts ``n_chars`` anew where there is one.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from math import inf, log10

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cantora.llm.common import map_batches, table
from cantora.llm.sentencepiece_codec import MODEL_PATH, SPACE, read_model

KINDS = ("assign", "access", "hex", "guess")


def _either_case(words: tuple[str, ...]) -> str:
    """An alternation that takes ASCII letters in either case, and no others (no Kelvin sign for k)."""
    return "|".join("".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else re.escape(c) if c != "?" else c for c in w) for w in words)


# The words of the assignment pattern.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = re.compile(rf"""({_either_case(ASSIGN_WORDS)})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs are matched whole, so asking for the length in the pattern gives the runs that are long enough.
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)

#: Words that make what follows a credential, in the corpus' languages; those that other words end in ("bypass", "enclave") must begin one.
CONTEXT_WORDS = ("password", "passwd", "passphrase", "passwort", "kennwort", "passcode", "contraseña", "pwd", "secret", "credential", "credentials", "token", "api_?key", "access_?key", "private_?key")
WHOLE_WORDS = ("clave", "pass", "auth", "bearer")
#: The value: up to the matching quote after an opening one (over lines too; a backslash takes the next character), else up to a blank or quote.
CONTEXT = re.compile(
    rf"""(?:{_either_case(CONTEXT_WORDS)}|(?<![^\W\d_])(?:{_either_case(WHOLE_WORDS)}))["']?[\x20\t]*+[:=][\x20\t]*+(?:"([^"\\]*+(?:\\.[^"\\]*+)*+)"|'([^'\\]*+(?:\\.[^'\\]*+)*+)'|["']?([^\s"']++))""", re.DOTALL
)
#: What a lower-cased text must hold for one of the patterns to match.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
CONTEXT_HINTS = ("pass", "secret", "token", "key", "contraseña", "clave", "pwd", "kennwort", "credential", "auth", "bearer")

MIN_LOG10_GUESSES, MIN_LENGTH = 10.0, 8
#: Words that are typical of passwords and of settings' placeholders, the likeliest first.
COMMON_WORDS = (
    "password", "admin", "welcome", "login", "user", "test", "guest", "root", "master", "dragon", "monkey", "letmein", "shadow", "sunshine", "princess", "football",
    "baseball", "secret", "superman", "batman", "trust", "hello", "freedom", "whatever", "ninja", "mustang", "access", "flower", "iloveyou", "server", "service", "database",
    "default", "system", "changeme", "example", "sample", "token", "placeholder", "redacted", "hidden", "masked", "required", "passwort", "geheim", "motdepasse", "contraseña", "key",
)
#: Words of fewer letters than this are left to brute force.
SHORTEST_WORD = 3
# Letters that signs stand for.
LEET = str.maketrans("430157$@!", "aeoistsai")
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
YEAR = re.compile(r"(?:19|20)\d\d")
DAY = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)")
DAY_LENGTHS = (6, 8, 10)
#: log10 of guesses: a character that nothing explains, a year, a date, a key, a turn, an inner capital, substitutions.
BRUTE, YEAR_COST, DAY_COST, KEY_COST, TURN_COST, CAPITAL_COST, LEET_COST = 1.0, 2.2, 4.6, 1.7, 0.6, 0.3, 0.5
UNIT, TIMES, HEAD = 32, 200, 512
_LONG_RUN = re.compile(r"(.{1,%d}?)\1{%d,}" % (UNIT, TIMES), re.DOTALL)
#: A web address without a user part.
PLACE = re.compile(r"https?://[^@\s]*", re.IGNORECASE)


def neighbours() -> dict[tuple[str, str], tuple[int, int]]:
    """The direction from one key to the next, for keys that touch. Each row lies half a key to the right of the one above."""
    at = {c: (r, k) for r, row in enumerate(KEYBOARD) for k, c in enumerate(row)}
    steps = ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1))
    return {(a, b): (r - y, k - x) for a, (y, x) in at.items() for b, (r, k) in at.items() if (r - y, k - x) in steps}


NEIGHBOURS = neighbours()
IN_ORDER = {(a, b): (0, d) for d in (1, -1) for a, b in zip(ALPHABET[::d], ALPHABET[::d][1:], strict=False)}


def read_words(path: str = MODEL_PATH) -> list[str]:
    """The dictionary, likeliest first: COMMON_WORDS, then the words that begin a piece of the vocabulary, lower-cased."""
    import sentencepiece

    vocabulary = sentencepiece.SentencePieceProcessor(model_proto=read_model(path))
    found = (vocabulary.id_to_piece(i) for i in range(vocabulary.get_piece_size()))
    words = (p[1:].lower() for p in found if p[0] == SPACE and p[1:].isalpha() and len(p) > SHORTEST_WORD)
    return [*dict.fromkeys((*COMMON_WORDS, *words))]


class Guesser:
    def __init__(self, words: list[str]):
        self.rank = {w: k for k, w in reversed([*enumerate(words, 1)])}
        self.longest = max(map(len, words), default=0)
        self.units: dict[str, float] = {}

    def segments(self, value: str, low: str, plain: str, i: int) -> Iterator[tuple[int, float]]:
        """(end, cost) of all segments of ``value`` from ``i`` on. low: in lower case, plain: with letters for signs."""
        n = len(value)
        yield i + 1, BRUTE
        for e in range(i + SHORTEST_WORD, min(n, i + self.longest) + 1):
            if rank := self.rank.get(low[i:e]):
                yield e, log10(rank + 1) + (0.0 if value[i:e].islower() else CAPITAL_COST)
            elif rank := self.rank.get(plain[i:e]):
                yield e, log10(rank + 1) + LEET_COST
        if value[i].isdigit():
            if YEAR.match(value, i):
                yield i + 4, YEAR_COST
            for size in DAY_LENGTHS:
                if DAY.fullmatch(value, i, i + size) and i + size <= n:
                    yield i + size, DAY_COST
        for steps in (NEIGHBOURS, IN_ORDER):
            e, turns, before = i + 1, 0, None
            while e < n and (step := steps.get((low[e - 1], low[e]))):
                turns += before is not None and step != before
                before = step
                e += 1
                if e - i > 2:
                    yield e, KEY_COST + log10(e - i) + TURN_COST * turns
        first_unit, first_end, p = 0, 0, i
        while (p := low.find(low[i], p + 1, i + (n - i) // 2 + 1)) > 0:
            unit = low[i:p]
            size = p - i
            # a long unit that is a repeat itself
            if size > UNIT and first_unit and size % first_unit == 0 and first_end >= i + 2 * size:
                continue
            times, e = 1, p
            while low.startswith(unit, e):
                if times == 1:
                    own = self._unit(value[i:p])
                times, e = times + 1, e + size
                if e - i > 2:
                    yield e, own + log10(min(times, TIMES))
            if times > 1 and not first_unit:
                first_unit, first_end = size, e

    def _unit(self, unit: str) -> float:
        """The cost of a unit, which repeats in repeats ask for again and again."""
        if unit not in self.units:
            if len(self.units) > 10_000:
                self.units.clear()
            self.units[unit] = self.cost(unit)
        return self.units[unit]

    def cost(self, value: str, enough: float = inf) -> float:
        """log10 of the guesses that the cheapest segmentation of ``value`` takes, or a lower bound of it that is at least ``enough``."""
        if len(value) > HEAD:
            if enough < inf and (least := self._cheapest(value[:HEAD], enough)[1]) >= enough:
                return least
            value = _LONG_RUN.sub(lambda m: m[1] * (TIMES + 1), value)
        return max(self._cheapest(value, enough))

    def _cheapest(self, value: str, enough: float) -> tuple[float, float]:
        """The cost of the whole (-1 if it broke off), and what everything that was open cost at least when the search broke off (-1 if it didn't)."""
        low = "".join(c if len(c) == 1 else "?" for c in map(str.lower, value))
        plain = low.translate(LEET)
        cost, reach = [0.0] + [inf] * len(value), 0
        for i in range(len(value)):
            if (least := min(cost[i : reach + 1])) >= enough:
                return -1.0, least
            for e, more in self.segments(value, low, plain, i):
                if cost[i] + more < cost[e]:
                    cost[e] = cost[i] + more
                    reach = max(reach, e)
        return cost[-1], -1.0


def base_spans(text: str, low: str | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed. ``low``: the lower-cased text, for quick refusal."""
    out: list[tuple[int, int, str]] = []
    low = text.lower() if low is None else low
    if any(x in low for x in ASSIGN_HINTS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def all_spans(text: str, guesser: Guesser) -> tuple[list[tuple[int, int, str]], float]:
    """Base spans and guess spans, sorted alike, and the largest guess cost of any credential value."""
    low = text.lower()
    spans = base_spans(text, low)
    most = 0.0
    if any(x in low for x in CONTEXT_HINTS):
        more: list[tuple[int, int, str]] = []
        at = 0
        while m := CONTEXT.search(text, at):
            start, at = m.span(m.lastindex)
            value = m[m.lastindex]
            place = PLACE.fullmatch(value)
            if m.lastindex < 3 or place:
                # what is in quotes or in an address is searched too: a stray quote mustn't hide a credential behind it
                at = start
            if m.lastindex == 3:
                value = value.rstrip(".,;:)]}")
            if len(value) < MIN_LENGTH or place:
                continue
            cost = guesser.cost(value, MIN_LOG10_GUESSES)
            most = max(most, cost)
            end = start + len(value)
            if cost >= MIN_LOG10_GUESSES and not any(s <= start and end <= e for s, e, _ in more[-1:]):
                more.append((start, end, "guess"))
        if more:
            spans = sorted(spans + more, key=lambda s: (s[0], KINDS.index(s[2])))
    return spans, most


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, words: list[str]) -> DataFrame:
    """A row for each document: counts by kind, the spans, and the largest log10 guess cost. ``words``: the dictionary, of bounded size as its file is."""

    def make() -> Callable:
        guesser = Guesser(words)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [all_spans(t or "", guesser) for t in b.column("text").to_pylist()]
            base = [[s for s in spans if s[2] != "guess"] for spans, _ in found]
            count = lambda kind: pa.array([sum(s[2] == kind for s in spans) for spans, _ in found], pa.int64())
            return pa.RecordBatch.from_arrays(
                [b.column("doc_id"), count("assign"), count("access"), count("hex"), pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base], pa.string()), pa.array([written(s) for s, _ in found], pa.string()), count("guess"), pa.array([c for _, c in found], pa.float64())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "max_guess_log10"],
            )

        return run

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, max_guess_log10 double")


def redacted(text: str, guesser: Guesser) -> str:
    """The text with its secrets replaced by ``[secret]``; overlapping spans become one."""
    out, at, until = [], 0, -1
    for s, e, _ in all_spans(text, guesser)[0]:
        if s >= until:
            out += [text[at : max(s, at)], "[secret]"]
        at = until = max(until, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, words: list[str]) -> DataFrame:
    """``docs`` with secrets taken out of the texts, and n_chars counted anew. All rows and columns stay."""
    schema = docs.schema

    def make() -> Callable:
        guesser = Guesser(words)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            new = [None if t is None else redacted(t, guesser) for t in b.column("text").to_pylist()]
            columns = {name: b.column(name) for name in b.schema.names}
            columns["text"] = pa.array(new, b.column("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([old if t is None else len(t) for t, old in zip(new, columns["n_chars"].to_pylist(), strict=True)], columns["n_chars"].type)
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        return run

    return map_batches(docs, make, schema)


def op1_secret_scan(spark: SparkSession, sf_dir: str, vocabulary: str = MODEL_PATH) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    return scan(table(spark, sf_dir, "documents"), read_words(vocabulary))
