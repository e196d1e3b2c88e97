"""Sizes of texts in tokens of a public tokenizer. The vocabulary file's path is a parameter; executors read it themselves."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pre-tokenizer pattern that belongs to the byte-level vocabularies
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ENCODERS: dict[str, Callable[[list[str]], list[list[int]]]] = {}


def encoder(path: str = VOCABULARY) -> Callable[[list[str]], list[list[int]]]:
    """A function that gives the token ids of each text; the kind of vocabulary follows from the file's ending."""
    if path not in _ENCODERS:
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            encoding = tiktoken.Encoding("vocabulary", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
            _ENCODERS[path] = lambda texts: [encoding.encode_ordinary(t) for t in texts]
        elif path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            _ENCODERS[path] = lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        elif path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _ENCODERS[path] = lambda texts: model.encode(texts, num_threads=1)
        else:
            raise ValueError(f"unknown kind of vocabulary: {path}")
    return _ENCODERS[path]


def decoder(path: str = VOCABULARY) -> Callable[[list[int]], str]:
    """A function that gives the text of token ids of a byte-level vocabulary."""
    if not path.endswith(".tiktoken"):
        raise ValueError(f"only byte-level vocabularies give texts back exactly: {path}")
    with open(path, "rb") as f:
        pieces = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    return lambda ids: b"".join(map(pieces.__getitem__, ids)).decode()


def counter(path: str = VOCABULARY) -> Callable[[list[str]], list[int]]:
    """A function that gives the number of tokens of each text."""
    encode = encoder(path)
    return lambda texts: [len(ids) for ids in encode(texts)]


def document_sizes(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens) of every text that is not null or empty; source is trimmed and lower-cased, null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            sizes = pa.array(count(batch.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), sizes], ["doc_id", "source", "tokens"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.trim("source")).alias("source"), "text").where("text is not null and text <> ''")
    return texts.mapInArrow(run, "doc_id long, source string, tokens long")
