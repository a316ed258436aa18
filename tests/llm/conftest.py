import pytest


@pytest.fixture
def texts(spark):
    """Documents from (doc_id, text[, lang]) rows, with columns whose names clash with internal ones."""
    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 7, "x", 1) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, node string, key int")
    return make


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "same words here and there"), (6, "same words here and there"),
       (6, "same words here and there"), (7, "long " * 40_000), (None, "no id for this text"), (8, "naïve Ünïcode 日本 \x00 end")]
