"""Secret scans: fixed patterns, and a guess-cost estimate for values in a credential's context.

The cost of a value is the logarithm of the guesses that an informed attacker needs. Dynamic programming finds the cheapest
way to cut it into known words, dates, repeats, keyboard walks and brute-force spans. A value that is costly enough is a
secret; `password = changeme` is not.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import with_columns

KINDS = ("assign", "access", "hex", "password")
#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Contexts of the guess-cost scan: more names, and values with any visible characters.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|auth(?:orization)?|bearer|credentials?|(?:private|access|client|signing)_?(?:key|secret))"""
    r"""["']?\x20*[:=]\x20*""",
    re.I | re.A,
)
#: A scheme may stand between a context and its value, as in `Authorization: Bearer ...`.
SCHEME = re.compile(r"(?:bearer|basic|token|negotiate|api_?key|jwt)\x20+", re.I | re.A)
QUOTED, BARE = re.compile(r"""\"([^"\n]+)"|'([^'\n]+)'""", re.A), re.compile(r"""[^\s"',;<>]+""", re.A)
#: How the path of a file or page begins.
PATH = re.compile(r"~?/|\.{1,2}/|[A-Za-z]:/|[a-z]+://", re.A)
#: A value is a secret from so many guesses (as a power of two) on.
LEAST_BITS = 40.0
#: A repeated unit has at most so many characters.
LONGEST_UNIT = 64
#: Common parts of passwords, the most common first. `ranked_words` adds a vocabulary's words; any list can be given.
WORDS = (
    "password pass admin welcome login letmein secret master dragon monkey shadow sunshine princess football baseball "
    "superman batman trustno hello freedom whatever qwerty test guest root user default changeme example sample dummy "
    "your token key value here none null true false summer winter spring autumn monday friday january december love money "
    "flower cookie charlie michael jordan thomas daniel george computer internet server database access private public "
    "secure security company office apple google star tiger the and you for with that this have from"
).split()
#: Letters that digits and signs stand for.
LEET = str.maketrans("4@8310!57$", "aabeioisss")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")


@cache
def _neighbours() -> set[tuple[str, str]]:
    """Pairs of keys side by side on a keyboard, also one row down, and consecutive letters and digits."""
    place = {c: (r, k + r * 0.5) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
    near = {(a, b) for a, (r, x) in place.items() for b, (s, y) in place.items() if a != b and abs(r - s) <= 1 and abs(x - y) <= 1}
    runs = ("abcdefghijklmnopqrstuvwxyz", "0123456789")
    return near | {p for run in runs for a, b in zip(run, run[1:]) for p in ((a, b), (b, a))}


DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d|(?:19|20)\d\d"
)
YEAR = re.compile(r"(?:19|20)\d\d")
#: Guesses, as powers of two, for a day in 130 years, and for a key to begin a walk at.
DATE_BITS, START_BITS = math.log2(365 * 130), math.log2(47)


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if "a" <= c <= "z":
        return math.log2(26)
    return math.log2(52) if "A" <= c <= "Z" else math.log2(95)


@cache
def ranked_words(path: str | None) -> tuple[str, ...]:
    """WORDS and behind them the whole words (three letters or more) of a word-piece vocabulary, which has them by frequency.

    path: a file of the `tokenizers` library whose words end in </w>; None: WORDS alone.
    """
    if path is None:
        return tuple(WORDS)
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    whole = sorted((rank, w[:-4]) for w, rank in vocabulary.items() if w.endswith("</w>"))
    return tuple(dict.fromkeys([*WORDS, *(w for _, w in whole if len(w) >= 3 and w.isascii() and w.isalpha())]))


class Guesses:
    """The guess cost of values. Its segments:

    - a character by itself: the bits of its class;
    - a word of the list, in any case, also with digits and signs for letters: the bits of its rank, one for being a word, and
      those of its capitals and signs;
    - a date or a year;
    - a keyboard walk of three keys or more: a start, a length, and a bit for each change of direction;
    - a repeat: one or more copies (of one character two or more) of the unit of up to LONGEST_UNIT characters before them, for
      the logarithm of their number.
    """

    def __init__(self, words: Iterable[str] = WORDS):
        self.bits = {w.lower(): math.log2(rank + 2) for rank, w in reversed(list(enumerate(words)))}
        self.longest = max(map(len, self.bits), default=0)

    def word(self, value: str, low: str, plain: str, i: int, j: int) -> float:
        """Bits of value[i:j] as a word; infinite if it is none."""
        cost = math.inf
        for text, extra in ((low, 0.0), (plain, 1.0)):
            if (bits := self.bits.get(text[i:j])) is not None:
                upper = sum(c.isupper() for c in value[i:j])
                shift = 0.0 if not upper else 1.0 if upper in (1, j - i) else min(upper, j - i - upper) + 1.0
                cost = min(cost, bits + extra + shift + 1)
        return cost

    def cost(self, value: str, enough: float = math.inf) -> float:
        """The least number of bits over all cuts of `value` into segments. If that is `enough` or more, some number that is.

        With `enough` the search ends where all cuts that go on have reached it, so a long random value costs no more than
        its beginning.
        """
        n, low = len(value), value.lower()
        low = low if len(low) == n else value
        plain = low.translate(LEET)
        keys, near = low.translate(SHIFTED), _neighbours()
        best = [0.0] + [math.inf] * n
        by = [(1, -1)] * (n + 1)  # the unit's length and the copies where the least cost is a repeat's
        dates: dict[int, list[int]] = {}
        steps = turn = 0  # of the walk that ends here: its steps, and all changes of direction so far
        turns = [0] * (n + 1)
        same = 0
        run = [0] * (LONGEST_UNIT + 1)  # by period: how many characters up to here equal those one period before
        starts: dict[tuple[int, int], list[int]] = defaultdict(list)  # by period and place modulo it: where copies can begin
        for j in range(1, n + 1):
            if value[j - 1].isdigit():
                for m in (DATE.match(low, j - 1), YEAR.match(low, j - 1)):
                    if m:
                        dates.setdefault(m.end(), []).append(j - 1)
            cost, unit, reach = best[j - 1] + _char_bits(value[j - 1]), (1, -1), max(0, j - max(self.longest, 10))
            for i in range(max(0, j - self.longest), j):
                if (bits := self.word(value, low, plain, i, j) + best[i]) < cost:
                    cost = bits
            for i in dates.get(j, ()):
                cost = min(cost, best[i] + DATE_BITS)
            turns[j] = turns[j - 1]
            if j > 1 and (keys[j - 2], keys[j - 1]) in near:
                step = ord(keys[j - 1]) - ord(keys[j - 2])
                turns[j] += steps > 0 and step != same
                steps, same = steps + 1, step
                reach = min(reach, j - 1 - steps)
                for k in range(2, steps + 1):
                    i = j - 1 - k
                    bits = START_BITS + math.log2(k + 1) + 1 + turns[j] - turns[i + 2]
                    if bits >= cost:
                        break
                    cost = min(cost, best[i] + bits)
            else:
                steps = 0
            for p in range(1, min(LONGEST_UNIT, j - 1) + 1):
                if value[j - 1] != value[j - 1 - p]:
                    run[p] = 0
                    continue
                run[p] += 1
                at, first = starts[p, j % p], j - run[p]
                if run[p] == 1:
                    for r in range(p):
                        starts[p, r].clear()
                i = j - p
                if i >= first and i >= p:
                    q, copies = by[i]
                    # A start that was itself reached by enough copies of a part of this unit: more of them cost no more.
                    if not (p % q == 0 and run[q] >= p and copies + 1 >= p // q):
                        at.append(i)
                reach = min(reach, max(first, p))
                for i in reversed(at):
                    times = (j - i) // p
                    bits = math.log2(times + 1)
                    if bits >= cost:
                        break
                    if best[i] + bits < cost and (p > 1 or times >= 2):
                        cost, unit = best[i] + bits, (p, times)
            best[j], by[j] = cost, unit
            if cost >= enough and min(best[max(0, reach) : j]) >= enough:
                return cost
        return best[n]


class Scanner:
    def __init__(self, words: Iterable[str] = WORDS, least_bits: float = LEAST_BITS):
        self.guesses, self.least_bits = Guesses(words), least_bits

    def strong(self, value: str) -> bool:
        """It costs `least_bits` or more. A path is as costly as its costliest part: naming a file is no secret."""
        if not PATH.match(value):
            return self.guesses.cost(value, self.least_bits) >= self.least_bits
        return any(self.guesses.cost(x, self.least_bits) >= self.least_bits for x in value.split("/"))

    def _values(self, text: str) -> Iterator[tuple[int, int]]:
        """Secrets in a credential's context. A value that is none may itself begin with a context or hold one."""
        at = bare = 0  # bare: the end of the last unquoted value
        last: dict[str, int] = {}  # where the values within that one begin, by the context before them
        cheap: list[tuple[int, int, int]] = []  # repeats in it (begin, period, end) within which no value is a secret
        while head := CONTEXT.search(text, at):
            a = head.end()
            scheme = SCHEME.match(text, a)
            for a in (scheme.end(), a) if scheme else (a,):
                quoted = QUOTED.match(text, a)
                if quoted or a < bare or BARE.match(text, a):
                    break
            else:
                at = head.end()
                continue
            if quoted:
                a, b = quoted.span(1 if quoted[1] is not None else 2)
            elif a < bare:
                b = bare
            else:
                b = bare = BARE.match(text, a).end()
                last, cheap = {}, []
            if not quoted:
                name = text[head.start() : a]
                begin, last[name] = last.get(name), a
                if any((a - x) % period == 0 and a < y for x, period, y in cheap):
                    at = a
                    continue
                if begin is not None and text.startswith(unit := text[begin:a], a):
                    end, times = a + len(unit), 2
                    while end + len(unit) <= b and text.startswith(unit, end):
                        end, times = end + len(unit), times + 1
                    # A value that begins at one of the units is at most one unit, its repeats and the rest.
                    if end <= b and self.guesses.cost(unit, self.least_bits) + math.log2(times) + self.guesses.cost(text[end:b], self.least_bits) < self.least_bits:
                        cheap.append((begin, len(unit), end))
                        at = a
                        continue
            if self.strong(text[a:b]):
                yield a, b
                at = b
            else:
                at = a

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, number of the kind, end) of all secrets, in code points, ordered by start and kind."""
        found = []
        if ":" in text or "=" in text:
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
            found += [(a, 3, b) for a, b in self._values(text)]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)


@cache
def scanner(words: tuple[str, ...], least_bits: float) -> Scanner:
    """One for each worker process."""
    return Scanner(words, least_bits)


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, text: str = "text", least_bits: float = LEAST_BITS, words: Iterable[str] = WORDS, keep: list[str] | None = None) -> DataFrame:
    """The rows of `docs` with n_assign, n_access, n_hex, n_password, base_sha256 and spans.

    spans lists kind:start:end of all secrets, base_sha256 is the digest of those of the three base kinds. Null and empty
    texts have none. Columns that have one of these names are replaced.
    """
    words = tuple(words)

    def maker():
        spans_of = scanner(words, least_bits).spans

        def make(texts):
            found = [spans_of(t) for t in texts.to_pylist()]
            counts = [pa.array([sum(k == kind for _, k, _ in x) for x in found], pa.int64()) for kind in range(4)]
            base = [hashlib.sha256(_listed([s for s in x if s[1] < 3]).encode()).hexdigest() for x in found]
            return [*counts, pa.array(base), pa.array(list(map(_listed, found)))]

        return make

    return with_columns(docs, text, "n_assign long, n_access long, n_hex long, n_password long, base_sha256 string, spans string", maker, keep)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", least_bits: float = LEAST_BITS, words: Iterable[str] = WORDS) -> DataFrame:
    """`docs` with each secret (overlapping ones together) replaced by [SECRET], as column `redacted`, and n_secrets."""
    words = tuple(words)

    def maker():
        spans_of = scanner(words, least_bits).spans

        def make(texts):
            texts = texts.to_pylist()
            found = [spans_of(t) for t in texts]
            return [pa.array([redacted(t, s) for t, s in zip(texts, found)], pa.string()), pa.array(list(map(len, found)), pa.int64())]

        return make

    return with_columns(docs, text, "redacted string, n_secrets long", maker)
