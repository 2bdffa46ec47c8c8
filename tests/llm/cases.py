"""Rows that every training-data operator must take: nulls, empties, ties, repeats, long texts, clashing names."""

import re

LONG = " ".join(f"w{i % 977} z{i % 13}" for i in range(40_000))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, h long, key string, a long, node long, w string, t string, _all string, _th string, _n long, row long, fp long, lang_pred string, component_id long, _id long, bucket long, length long"
EXTRA = ("x", "x", 1, 2, 3, "x", 4, 5, 6, 7)
PROSE = "The quick brown fox jumps over the lazy dog near the river bank while seven wise owls watch from tall trees. " * 3


def rows():
    texts = [None, "", " \t\n", "one", "one two", PROSE, PROSE, PROSE + " more", LONG, "éà ü ñ 漢字 😀 tail", "x\x00y \x0b\x0c z", "A a A a A a A", "###"]
    out = [(i, t, ("en", "fr", None)[i % 3], ("s0", None, "s2")[i % 3], None if t is None else len(t), 0.5, 1, "k", 2, 3, "w", "t", *EXTRA) for i, t in enumerate(texts)]
    return out + [out[5], (None, PROSE, *[None] * (len(out[0]) - 2))]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, COLUMNS)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})
