"""Small tables with the awkward cases: nulls, empty and long texts, copies, repeated rows, clashing extra columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EN = "the of and with that this from was are for over under light river stone".split()
DE = "der die und mit das nicht sich auf ist dem strasse wasser licht brot haus".split()


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def document_rows():
    rng = random.Random(5)
    rows = [(i, sentence(rng, EN if i % 2 else DE, 30 + i % 50), "en" if i % 2 else "de") for i in range(120)]
    long = sentence(rng, EN, 6000)
    base = sentence(rng, [f"w{i}" for i in range(400)], 300).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in (20, 120, 220)]
    rows += [(200, None, "en"), (201, "", "en"), (202, "  \n ", None), (203, "12 34 -- !!", "de"), (204, long, "en"), (205, long, "en"),
             (206, " ".join(base), "en"), *[(207 + i, t, "en") for i, t in enumerate(near)],
             (210, "Über die Straße 你好 мир naïve 😀 the end", None), (211, "one two", "en"), (212, "one two", "en"), (None, "no id here at all", "en")]
    rows += [rows[3], rows[3]]
    return [(i, t, lang, "src0", None if t is None else len(t)) for i, t, lang in rows]
