"""Small tables for the tests of the training-data operators."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, sources=None, langs=None, extra=""):
    """Documents 0, 1, ... with the given texts; ``extra`` adds columns as SQL expressions."""
    rows = [
        (i, t, (langs or ["en"] * len(texts))[i], (sources or ["a"] * len(texts))[i], len(t or ""))
        for i, t in enumerate(texts)
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.selectExpr("*", extra) if extra else frame


def rows(frame, *names):
    """The rows as sorted tuples of some columns."""
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)
