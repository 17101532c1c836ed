"""Text expressions (P3, P4, P10, F6-F12, J11): native Column expressions.

Regex dialect note: the rules are written in Python's dialect.  Java's ``.`` also
stops at ``\\r`` and Unicode line separators and its ``\\s``/``\\d`` are ASCII unless
``(?U)`` is set, so claim patterns get ``(?d)`` (only ``\\n`` ends a line, as in
Python) and the price pattern gets ``(?U)``.
"""

from __future__ import annotations

import re
from functools import reduce
from re import _constants as _ops
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from sourcelens.rules import BrandRules


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def spark_claim_regex(patterns) -> str:
    """One fused alternation per claim: a single regex scan instead of one per pattern."""
    return "(?d)" + "|".join(f"(?:{p})" for p in patterns)


def spark_price_regex(pattern: str) -> str:
    return "(?U)" + pattern


def cap(col, n: int | None = None) -> Column:
    """P10: first ``n`` characters (code points); the whole text unless ``n`` is given."""
    return _c(col) if n is None else F.left(_c(col), F.lit(n))


def nullif_empty(col) -> Column:
    c = _c(col)
    return F.when(c == "", F.lit(None)).otherwise(c)


def first_nonempty(*cols) -> Column:
    """Python's ``a or b or c`` over strings: first value that is neither null nor empty."""
    return F.coalesce(*[nullif_empty(c) for c in cols])


def _runs(parsed) -> list[str]:
    """The literal strings that every match of a parsed pattern holds, in order."""
    runs, now = [], ""
    for op, value in parsed:
        if op is _ops.LITERAL:
            now += chr(value)
            continue
        runs, now = [*runs, now], ""
        if op is _ops.SUBPATTERN and not value[1] & re.IGNORECASE:
            runs += _runs(value[3])
        elif op in (_ops.MAX_REPEAT, _ops.MIN_REPEAT) and value[0] > 0:
            runs += _runs(value[2])
    return [r for r in [*runs, now] if r]


def required_literals(pattern: str) -> list[str]:
    """The distinct strings that any text must hold for ``pattern`` (in Python's dialect) to match, longest first; without those inside a
    longer one.  Empty where the pattern's beginning, a choice or a flag leaves none."""
    try:
        parsed = _parser.parse(pattern)
    except re.error:
        return []
    if parsed.state.flags & (re.IGNORECASE | re.VERBOSE):
        return []
    found = sorted(set(_runs(parsed)), key=lambda r: (-len(r), r))
    return [r for i, r in enumerate(found) if not any(r in longer for longer in found[:i])]


def claim_flag(ltext, patterns) -> Column:
    """One claim: the fused alternation, run only on texts that hold the literals one of its patterns needs.  Looking for a literal costs a small part of a
    regex scan, and most texts lack most claims' literals.  A pattern without any is always run."""
    if not patterns:
        return F.lit(False)
    t = _c(ltext)
    needs = [required_literals(p) for p in patterns]
    found = t.rlike(spark_claim_regex(patterns))
    if all(needs):
        may = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [t.contains(x) for x in need]) for need in needs])
        found = F.when(may, found)
    return F.coalesce(found, F.lit(False))


def lowered(text) -> Column:
    return F.lower(F.coalesce(_c(text), F.lit("")))


def claim_flags(text, rules: BrandRules, lower_text=None) -> dict[str, Column]:
    """One boolean per claim plus ``current_signal``, on the lower-cased text (pass
    ``lower_text`` when it is already a column, so it is computed once per row)."""
    lt = lower_text if lower_text is not None else lowered(text)
    out = {name: claim_flag(lt, pats) for name, pats in rules.claim_patterns}
    out["current_signal"] = claim_flag(lt, rules.current_signal_patterns)
    return out


def any_claim(cols) -> Column:
    """OR of named boolean columns."""
    cols = [_c(c) for c in cols]
    if not cols:
        return F.lit(False)
    return reduce(lambda a, b: a | b, cols)


def prices_seen(text, rules: BrandRules, n: int | None = None) -> Column:
    """F6 + O2: distinct price strings, sorted as strings; all of them unless ``n`` is given."""
    found = F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(spark_price_regex(rules.price_pattern)), 0)
    prices = F.array_sort(F.array_distinct(found))
    return prices if n is None else F.slice(prices, 1, n)


def brand_hit(ltext, name: str, word_boundary: bool) -> Column:
    lt = _c(ltext)
    if word_boundary:
        import re
        return F.coalesce(lt.rlike(r"(?U)\b" + re.escape(name.lower()) + r"\b"), F.lit(False))
    return F.coalesce(lt.contains(name.lower()), F.lit(False))


def brands_in(text, brands, word_boundary: bool = False, lower_text=None) -> Column:
    """F8: brands named in the text, in catalog order (array).  Built as one array of
    ``when`` columns plus ``array_compact`` so it stays inside whole-stage codegen.  Spark
    does not share a common subexpression across the ``when`` branches, so pass the
    lower-cased text as a column (``lower_text``) when it is used more than once."""
    lt = lower_text if lower_text is not None else lowered(text)
    if not brands:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(brand_hit(lt, b, word_boundary), F.lit(b)) for b in brands]))


def mentions_brand(text, rules: BrandRules, lower_text=None) -> Column:
    lt = lower_text if lower_text is not None else lowered(text)
    return brand_hit(lt, rules.brand, rules.word_boundary)


def best_text(body, snippet) -> Column:
    """the richer of body and snippet; a tie keeps the body."""
    b = F.coalesce(_c(body), F.lit(""))
    s = F.coalesce(_c(snippet), F.lit(""))
    return F.when(F.length(b) >= F.length(s), b).otherwise(s)


def names_summary(comps) -> Column:
    """``Names: a, b`` or ``''``."""
    c = _c(comps)
    return F.when(F.size(c) > 0, F.concat(F.lit("Names: "), F.array_join(c, ", "))).otherwise(F.lit(""))


def narrative(stale, mentioned, rules: BrandRules, stale_note: str) -> Column:
    """Three-way fallback narrative used by F9 and F10 (``mentioned``: the brand is named)."""
    return (F.when(_c(stale), F.lit(stale_note))
             .when(_c(mentioned), F.lit(rules.mentions_note()))
             .otherwise(F.lit(rules.no_mention_note())))


def ad_copy(variants) -> Column:
    """non-empty text, headline, description and body of every variant, space-joined."""
    parts = F.flatten(F.transform(
        _c(variants), lambda v: F.array(v["text"], v["headline"], v["description"], v["body"])))
    return F.coalesce(F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), " "), F.lit(""))
