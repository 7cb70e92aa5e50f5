import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(*rows, extra=()):
        full = []
        for row in rows:
            number, text, lang, source = (*row, "en", "s")[:4] if len(row) < 4 else row
            full.append((number, text, lang, source, None if text is None else len(text), *extra_values(extra)))
        schema = DOCUMENTS + "".join(f", `{name}` string" for name in extra)
        return spark.createDataFrame(full, schema)

    return build


def extra_values(extra):
    return ["kept as it is"] * len(extra)
