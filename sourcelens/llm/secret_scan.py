"""Secret scan: fixed patterns plus a guess-cost model for values in credential context.

Fixed patterns (``assign``, ``access``, ``hex``) are as the caller's contract gives them.  Besides, each value that stands
in credential context (``password: ...``, ``pwd=...``, ``https://user:...@host``) and isn't wholly inside one such match is priced whole: dynamic
programming finds the cheapest way to write it as words, dates, repeats, keyboard walks and brute-force spans, in powers
of ten of guesses.  Values that cost at least ``MIN_GUESSES`` are spans of kind ``guess``; cheap ones
(``password: example``) are left alone.

Defined cases: a null text is an empty one; spans are code points, end exclusive; texts and values of any length are read
whole (the model is linear in the value's length); extra columns are kept.
"""

from __future__ import annotations

import hashlib
import re
from math import log10

from pyspark.sql import DataFrame

from sourcelens.llm.common import map_rows

# fixed values: the base patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|api[_-]?key|access[_-]?key|client[_-]?secret|"""
                     r"""auth(?:orization)?|credentials?|private[_-]?key)["']?\s{0,8}(?:=>|:=|[:=])\s{0,8}(?:bearer\s{1,8}|basic\s{1,8})?["']?"""
                     r"""([^\s"'<>,;|()\[\]{}]{6,})""", re.I | re.A)
USERINFO = re.compile(r"://[^\s/:@]++:([^\s/@]{6,}+)@")  # possessive: linear, however long
HINTS = ("pass", "pwd", "pin", "secret", "token", "key", "auth", "credential")
#: A value is a secret from so many guesses on (a power of ten).
MIN_GUESSES = 10.0
#: What each further segment costs.
JOIN = 0.5

# words of passwords and of placeholders, commonest first
WORDS = ("password qwerty admin welcome login letmein dragon monkey master secret token example test guest user root changeme default "
         "hello love sunshine princess football baseball superman batman shadow summer winter spring autumn monday friday "
         "january march april june july august october november december computer internet server access manager private public "
         "system office company service database mysql oracle postgres django flask spring apache nginx docker cloud google "
         "amazon azure windows linux ubuntu apple orange banana cookie coffee pepper ginger tiger eagle falcon phoenix "
         "hunter ranger soccer hockey killer trust magic money power purple yellow silver golden diamond freedom forever "
         "flower family friend angel happy lucky your pass word here none null true false undefined redacted removed hidden "
         "placeholder sample dummy required optional string value field enter insert my the and for new old key api").split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
LONGEST = max(map(len, RANK))
LEET = str.maketrans("4@3105$7", "aaeiosst")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0987654321", "poiuytrewq",
        "lkjhgfdsa", "mnbvcxz", "zyxwvutsrqponmlkjihgfedcba", "1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")
NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:], strict=False)}


def _char_cost(value: str) -> float:
    kinds = ((r"[a-z]", 26), (r"[A-Z]", 26), (r"[0-9]", 10), (r"[^A-Za-z0-9]", 33))
    return log10(sum(n for p, n in kinds if re.search(p, value)))


def guess_cost(value: str) -> float:
    """Log10 of the guesses that the cheapest segmentation needs."""
    n = len(value)
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(LEET)
    each = _char_cost(value)
    best = [0.0] + [float("inf")] * n
    brute = [0.0] + [float("inf")] * n  # the cheapest that ends in an open brute-force span
    dates = {}
    for m in DATE.finditer(value):
        dates.setdefault(m.end(), []).append((m.start(), 2.1 if m.end() - m.start() == 4 else 4.6))
    walk = run = 1
    for i in range(1, n + 1):
        walk = walk + 1 if i > 1 and (low[i - 2], low[i - 1]) in NEXT else 1
        run = run + 1 if i > 1 and value[i - 1] == value[i - 2] else 1
        brute[i] = min(brute[i - 1], best[i - 1] + JOIN * (i > 1)) + each
        cost = brute[i]
        for size in range(3, min(LONGEST, i) + 1):
            word = low[i - size:i]
            rank = RANK.get(word)
            extra = 0.0
            if rank is None and (rank := RANK.get(plain[i - size:i])) is not None:
                extra = 0.6
            if rank is not None:
                cost = min(cost, best[i - size] + JOIN * (i > size) + log10(rank + 1) + extra + 0.5 * (value[i - size:i] != word))
        for start, price in dates.get(i, ()):
            cost = min(cost, best[start] + JOIN * (start > 0) + price)
        if walk >= 3:
            cost = min(cost, best[i - walk] + JOIN * (i > walk) + log10(len(NEXT)) + log10(walk))
        if run >= 3:
            cost = min(cost, best[i - run] + JOIN * (i > run) + each + log10(run))
        for period in (2, 3, 4):  # repeated groups
            if i >= 2 * period and value[i - period:i] == value[i - 2 * period:i - period]:
                cost = min(cost, best[i - period] + log10(2))
        best[i] = cost
    return best[n]


def base_spans(text: str, low: str | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    low = text.lower() if low is None else low
    found = []
    if "pass" in low or "secret" in low or "token" in low or "key" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, low: str, base: list[tuple[int, int, int]], least: float = MIN_GUESSES) -> list[tuple[int, int, int]]:
    found = []
    values = [(m.start(1), m.end(1)) for m in CONTEXT.finditer(text)] if any(h in low for h in HINTS) else []
    if "://" in text and "@" in text:
        values += [(m.start(1), m.end(1)) for m in USERINFO.finditer(text)]
    at = covered = 0  # covered: the farthest end of a base span or guess that begins no later
    for start, end in sorted(set(values), key=lambda v: (v[0], -v[1])):
        while at < len(base) and base[at][0] <= start:
            covered = max(covered, base[at][2])
            at += 1
        value = text[start:end].rstrip(".:!?*#$%&")
        end = start + len(value)
        if end <= covered:
            continue
        if guess_cost(value) >= least:
            found.append((start, 3, end))
            covered = end
    return found


def scan(text: str | None, least: float = MIN_GUESSES) -> tuple[list, list]:
    text = text or ""
    low = text.lower()
    base = base_spans(text, low)
    return base, sorted(base + guess_spans(text, low, base, least))


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def scan_documents(docs: DataFrame, text: str = "text", least: float = MIN_GUESSES, redacted: bool = False) -> DataFrame:
    """``docs`` plus n_assign, n_access, n_hex, n_guess, base_sha256, spans; with ``redacted``, the text without its secrets."""
    kept = docs.drop("n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields) + (
        "`n_assign` bigint, `n_access` bigint, `n_hex` bigint, `n_guess` bigint, `base_sha256` string, `spans` string")

    def run(columns):
        found = [scan(t, least) for t in columns[text]]
        counts = [[sum(k == kind for _, k, _ in spans) for _, spans in found] for kind in range(4)]
        if redacted:
            columns[text] = [redact(t, spans) if spans else t for t, (_, spans) in zip(columns[text], found, strict=True)]
        return {**columns, "n_assign": counts[0], "n_access": counts[1], "n_hex": counts[2], "n_guess": counts[3],
                "base_sha256": [hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in found],
                "spans": [shown(spans) for _, spans in found]}

    return map_rows(kept, run, schema)
