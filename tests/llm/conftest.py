"""Small tables for the operators of this subpackage."""

from __future__ import annotations

import pytest

WIDE = "doc_id long, text string, lang string, source string, n_chars long"
# columns named like those that operators make themselves
CLASHING = (
    "rank", "size", "bucket", "mix_point", "recipe", "dup_doc", "line_doc", "n_lines", "near_gone",
    "shard", "slice", "task", "start", "language", "block", "point", "text_sha256",
)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows, clashing=False):
        filled = [(*r, "en", f"s{(r[0] or 0) % 3}", 0)[:5] if len(r) == 2 else (*r, 0)
                  for r in rows]
        df = spark.createDataFrame([tuple(r[:5]) for r in filled], WIDE)
        if clashing:
            df = df.selectExpr("*", *[f"'{c}' as {c}" for c in CLASHING])
        return df

    return make


LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(60_000))
SAID = "the quick brown fox jumps over the lazy dog and then it sleeps for a long while again"

EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "a b c"), (7, SAID),
    (8, SAID), (9, SAID + " more"), (None, SAID), (None, None), (10, "a\n\nb\n"), (11, LONG),
    (12, LONG), (7, SAID), (7, "another text under an id that is there already, a long line"),
    (13, "ÀÉ ß İ ǅ 漢字 🙂 x"), (14, "1234 5678"),
]
