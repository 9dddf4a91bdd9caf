import re

import pyarrow as pa
from hypothesis import given, settings, strategies as st

import helpers  # noqa: F401
from eventide.llm import toxicity
from eventide.llm._text import WORD, slices, split_words


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ 9-é\x00\x7f\n,[{漢", max_size=30))))
def test_words_equal_the_pattern(texts):
    words = split_words(pa.array(texts, pa.string()))
    flat = [w.decode() for w in words.arrow().to_pylist()]
    for k, t in enumerate(texts):
        assert flat[words.first[k]:words.first[k + 1]] == re.findall(WORD, ascii_lower(t or ""))


def test_slices_cover_a_batch_and_sliced_columns_work():
    batch = pa.RecordBatch.from_arrays([pa.array(["abc def", None, "", "x" * 50, "y z"])], names=["t"])
    cut = list(slices(batch, "t", 10))
    assert [v for part in cut for v in part.column("t").to_pylist()] == batch.column("t").to_pylist()
    assert split_words(cut[-1].column("t")).arrow().to_pylist() == [b"y", b"z"]
    assert list(slices(batch.slice(0, 0), "t")) == []


def test_term_hashes_do_not_depend_on_the_batch():
    texts = ["one two", None, "loser one", "", "beginning"]
    buckets, count = toxicity.term_hashes(pa.array(texts))
    at = 0
    for t, n in zip(texts, count):
        alone, m = toxicity.term_hashes(pa.array([t], pa.string()))
        assert m[0] == n and list(buckets[at:at + n]) == list(alone)
        at += n
