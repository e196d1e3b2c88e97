import os

import pytest

from cohortqc.llm import tokens as T
from tests.util import rows

pytestmark = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no public vocabulary here")
FOLDER = os.path.dirname(T.VOCABULARY)


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"])
def test_vocabularies(name):
    n = T.counter(os.path.join(FOLDER, name))(["", "hello world", "🧬" * 10, "<|endoftext|>"])
    assert n[0] == 0 and n[1] >= 2 and n[2] >= 10 and n[3] > 1


def test_same_vocabulary_in_two_libraries():
    texts = ["The cat's  hat.\n\n 12345 µ Straße ☃🧬", "a" * 5000, " " * 3000, "x\t\ty"]
    assert T.counter(os.path.join(FOLDER, "byte_bpe_50k.tiktoken"))(texts) == T.counter(os.path.join(FOLDER, "byte_bpe_50k.json"))(texts)


def test_sizes(spark):
    docs = spark.createDataFrame([(1, "a b c", " Mail ", 5), (2, None, "x", 1), (3, "", "x", 1), (4, "hello", None, 1)], "doc_id long, text string, source string, tokens int")
    assert rows(T.document_sizes(docs)) == [(1, "mail", 3), (4, None, 1)]
    with pytest.raises(ValueError):
        T.counter("some.txt")
