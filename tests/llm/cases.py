"""Every awkward row in one small table, and a comparison of rows."""
LONG = "long words again and " * 6000
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ROWS = [
    (0, "The quick brown fox jumps over the lazy dog and runs away from it all.", "en", "a", 70),
    (1, "The quick brown fox  jumps over the lazy dog and runs away\nfrom it all.", "en", "b", 70),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\r\n\x0b\x0c", "de", "b", 6),
    (None, "A row without an id that says something of its own here.", "en", None, 56),
    (None, None, None, None, None),
    (5, "short", "en", "a", 5),
    (5, "short", "en", "a", 5),
    (6, "Short", "en", "c", 5),
    (7, LONG, "en", "a", len(LONG)),
    (8, "Ünïcödé tëxt mît \U0001f600 emoji and \u00a0 hard space \x85 kept", "de", "c", 40),
    (9, "The quick brown fox jumps over the lazy dog and runs away from it all.", None, "c", 70),
]


CLASHING = ["Text", "shard", "slot", "size", "n", "node", "row", "score", "kept", "h", "block", "words", "start", "rank"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
