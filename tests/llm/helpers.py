"""Plain Python versions of what the operators compute, for small tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    w = WORD.findall(lower(text))
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def similar(a, b):
    both = len(a & b)
    return bool(both) and 100 * both >= 75 * (len(a) + len(b) - both)


def table(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows] if "lang" in schema else rows
    return spark.createDataFrame(full, schema)


#: Nulls, empty and white-space texts, ties, repeats, a long text, odd characters.
ODD = [
    (1, None), (2, ""), (3, " \t\n \x0b"), (4, "one two three"), (5, "ONE two three"), (6, "one two three four five"), (6, "one two three four five"), (None, "no id here but five words at least"), (None, None),
    (7, "\n".join(f"line number {i} of the same text again and again" for i in range(40))), (8, "w" * 5000 + " x"), (9, "".join(f"word{i} " for i in range(30_000))), (10, "naïve café — “quoted” \u00a0 word\u2003x 中文 🙂 İ"),
    (11, "a a a a a a a a"), (12, "line\r\nline\r\nline"), (-5, "one two three"), (2**60, "big id with a few words in it"),
]
