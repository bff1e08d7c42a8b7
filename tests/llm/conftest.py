import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, node string, batch string, "
    "id string, key string, fp string, body string, epoch string, found string"
)


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (doc_id, text[, lang, source]); further columns carry names that the operators use inside."""

    def make(*rows, partitions=3):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), *["x"] * 9) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


LONG = " ".join(f"w{i % 977}{'a' * (i % 7)}" for i in range(30_000))

#: nulls in any column, empty and blank and very long texts, ties, repeated rows, one word of great length
AWKWARD = [
    (1, None, None, None), (2, "", "en", None), (3, " \n\t ", None, "src1"), (4, LONG, "en", "src1"), (5, LONG, "en", "src1"),
    (6, "one two three", "en", "src2"), (6, "one two three", "en", "src2"), (None, "one two three", "de", "src2"),
    (None, None, None, None), (7, "x" * 50_000, "fr", "src1"), (8, "one two three four five six", "en", "src3"),
    (8, "another text of the same id here", "en", "src3"), (9, "123 456 ... !!!", "en", "src1"), (10, "Ünïcödé ẞtraße Σίσυφος 😀", "de", "src9"),
]


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)
