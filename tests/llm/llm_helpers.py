"""Shared by the tests of the corpus operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
