import pyarrow as pa
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""

    def run(rows, more=True):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
        if more:
            df = df.selectExpr("*", "1 as fp", "'x' as shard", "array(1) as ids", "2.0d as score", "'y' as component_id")
        return df

    return run


def large(texts):
    return pa.array(texts, pa.large_string())


#: Texts at the edges: empty, white space, no words, other scripts, very long, joined by repeats.
ODD = ["", " ", "\n\n", "a", "a  b", " lead", "trail ", "x\n y", "tab\t tab", "漢字 かな", "🙂 🙂", "don't", "é é", "12345", "!!!", "<|endoftext|>", "a<|endoftext|> b", "\x00", "w" * 3000, "word " * 5000]
