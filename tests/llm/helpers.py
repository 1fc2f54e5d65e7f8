import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, host string, h string, key string, cc string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def docs(spark, rows):
    """Documents of (doc_id, text), with columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(i, t, None if i is None else "en", None if i == 1 else f"src{(i or 0) % 2}", None if t is None else len(t), 7, "x", "y", "z", "k", "c") for i, t in rows], DOCS)


AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "One"), (6, "a b c d e f g"), (6, "a b c d e f g"), (None, "a b c d e f g"), (None, None),
    (7, "Été à la plage \U0001f600 \x01 odd"), (8, "x" * 70_000), (9, "word " * 30_000), (10, "A B C D E F G"), (11, "1234 5678 !!"),
]
