"""BPE encoding and decoding of whole texts, with long unsplit words encoded in parallel.

Most texts are encoded where they lie (see ``tokens``). A text that holds a
run of ``LONG`` characters without white space is taken apart: its words of
over ``LEAF`` symbols are halved until the leaves are short, Spark spreads the
leaves over all tasks, and neighbouring halves are concatenated up the tree.
At each join a window around it is re-encoded and grown until its first and
last token agree with both sides. Then every adjacent pair of tokens is one
that the encoder itself puts side by side, and such a sequence is the
encoding of the whole word.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from .common import text_or_empty, written
from .tokens import encoder_for, library_tokenizer, vocabulary_text

LONG = 8192
LEAF = 1024
#: Bytes of output that a worker gathers before it hands a batch on.
FLUSH = 3_000_000


def _merges(parsed: dict) -> list[tuple[str, str]]:
    return [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parsed["model"]["merges"]]


class WordTree:
    """Encodes parts of one pre-split word (in the vocabulary's own characters) and joins them."""

    def __init__(self, vocabulary: str):
        parsed = json.loads(vocabulary)
        suffix = parsed["model"]["end_of_word_suffix"]
        self.ends: BPE = library_tokenizer(vocabulary).model
        # a part inside a word is encoded without the mark of a word's end
        self.inside = BPE(vocab=parsed["model"]["vocab"], merges=_merges(parsed)) if suffix else self.ends
        self.suffix = suffix or ""
        self.symbols = {i: s for s, i in parsed["model"]["vocab"].items()}

    def encode(self, part: str, last: bool) -> list[int]:
        return [t.id for t in (self.ends if last else self.inside).tokenize(part)]

    def spelled(self, ids: list[int], last: bool) -> str:
        text = "".join(map(self.symbols.__getitem__, ids))
        return text.removesuffix(self.suffix) if last and self.suffix else text

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The ids of both parts' text; ``last`` if the right part ends the word."""
        window = 1
        while True:
            a, b = min(window, len(left)), min(window, len(right))
            whole_left, whole_right = a == len(left), b == len(right)
            ids = self.encode(self.spelled(left[len(left) - a :], False) + self.spelled(right[:b], last and whole_right), last and whole_right)
            if (whole_left or ids[0] == left[len(left) - a]) and (whole_right or ids[-1] == right[b - 1]):
                return left[: len(left) - a] + ids + right[b:]
            window *= 2

    def concatenate(self, parts: list[list[int]], last: bool = True) -> list[int]:
        """Joins neighbours level by level, halves before wholes."""
        while len(parts) > 1:
            parts = [
                self.join(parts[i], parts[i + 1], last and i + 2 >= len(parts)) if i + 1 < len(parts) else parts[i]
                for i in range(0, len(parts), 2)
            ]
        return parts[0] if parts else []


_TREES: dict[str, WordTree] = {}


def tree_for(vocabulary: str) -> WordTree:
    if vocabulary not in _TREES:
        _TREES.clear()
        _TREES[vocabulary] = WordTree(vocabulary)
    return _TREES[vocabulary]


def halves(word: str) -> list[str]:
    if len(word) <= LEAF:
        return [word]
    middle = len(word) // 2
    return halves(word[:middle]) + halves(word[middle:])


def split_words(tokenizer: Tokenizer, specials: dict[str, int], text: str) -> Iterator[tuple[str | None, int]]:
    """The text's words in order, and special tokens as (None, id)."""
    for part in re.split("(" + "|".join(map(re.escape, specials)) + ")", text) if specials else [text]:
        if part in specials:
            yield None, specials[part]
        elif part:
            normal = tokenizer.normalizer.normalize_str(part) if tokenizer.normalizer else part
            for word, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                yield word, -1


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _by_row(convert: Callable, id_column: str, column: str, kind: pa.DataType) -> Callable:
    """A batch function that maps column 1 row by row and hands on a batch once it holds ``FLUSH`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = convert()
        for batch in batches:
            begun, size, out = 0, 0, []
            for row, cell in enumerate(batch.column(1)):
                out.append(one(cell.as_py()))
                size += len(out[-1])
                if size >= FLUSH or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begun, len(out)), pa.array(out, kind)], [id_column, column])
                    begun, size, out = row + 1, 0, []

    return run


def encode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id and ``ids`` (little-endian uint32), without added special tokens.

    Special tokens' strings inside a text become their ids, as the library
    does. Null and empty texts have no ids; repeated rows are encoded each on
    its own; an empty table gives no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary_path))
    rows = docs.select(F.col(id_column), text_or_empty(text_column).alias("_text"))
    kind = rows.schema[id_column].dataType.simpleString()
    is_long = (F.char_length("_text") >= LONG) & F.col("_text").rlike(r"\S{%d}" % LONG)
    short = rows.where(~is_long).mapInArrow(
        _by_row(lambda: encoder_for(sent.value).encode, id_column, "ids", pa.binary()), f"`{id_column}` {kind}, ids binary")
    return short.unionByName(_encode_long(rows.where(is_long), sent, id_column, kind))


def _encode_long(rows: DataFrame, sent, id_column: str, kind: str) -> DataFrame:
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "long-texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of short words as ids, long words as leaves."""
        tokenizer, tree = library_tokenizer(sent.value), tree_for(sent.value)
        specials = {t["content"]: t["id"] for t in json.loads(sent.value)["added_tokens"]}
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                out, run = [], []
                for number, (word, special) in enumerate(split_words(tokenizer, specials, text.as_py())):
                    if word is None:
                        run.append(special)
                    elif len(word) <= LEAF:
                        run += tree.encode(word, True)
                    else:
                        if run:
                            out.append((2 * number, 0, None, True, _packed(run)))
                            run = []
                        leaves = halves(word)
                        out += [(2 * number + 1, k, leaf, k == len(leaves) - 1, None) for k, leaf in enumerate(leaves)]
                if run:
                    out.append((1 << 40, 0, None, True, _packed(run)))
                words, piece, leaf, last, ids = zip(*out) if out else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(out), pa.int64()), pa.array(words, pa.int64()), pa.array(piece, pa.int32()), pa.array(leaf, pa.string()), pa.array(last, pa.bool_()), pa.array(ids, pa.binary())],
                    ["_row", "_word", "_piece", "_leaf", "_last", "ids"])

    def leaves_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = tree_for(sent.value)
        for batch in batches:
            ids = [
                done if leaf is None else _packed(tree.encode(leaf, last))
                for leaf, last, done in zip(*(batch.column(c).to_pylist() for c in ("_leaf", "_last", "ids")))
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_row", "_word", "_piece")), pa.array(ids, pa.binary())], ["_row", "_word", "_piece", "ids"])

    def up_the_tree(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        tree, whole = tree_for(sent.value), []
        for _, parts in frame.sort_values(["_word", "_piece"]).groupby("_word", sort=True):
            whole += tree.concatenate([np.frombuffer(x, "<u4").tolist() for x in parts["ids"]])
        return pd.DataFrame({"_row": [key[0]], "ids": [_packed(whole)]})

    parts = rows.select("_row", "_text").mapInArrow(cut, "_row long, _word long, _piece int, _leaf string, _last boolean, ids binary")
    encoded = parts.repartition("_row", "_word", "_piece").mapInArrow(leaves_only, "_row long, _word long, _piece int, ids binary")
    whole = encoded.groupBy("_row").applyInPandas(up_the_tree, "_row long, ids binary")
    return rows.select("_row", id_column).join(whole, "_row", "left").select(id_column, F.coalesce("ids", F.lit(b"")).alias("ids"))


def decode(encoded: DataFrame, vocabulary_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """One row per row: id and ``decoded`` text, special tokens included.

    Follows the vocabulary file: with no decoder the tokens are joined by
    spaces, with the byte-level one their bytes are read as UTF-8, bad bytes
    becoming U+FFFD. Null ids decode like none, to the empty text.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary_text(vocabulary_path))
    rows = encoded.select(F.col(id_column), F.coalesce(F.col(ids_column), F.lit(b"")).alias("_ids"))
    kind = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(_by_row(lambda: decoder_for(sent.value), id_column, "decoded", pa.string()), f"`{id_column}` {kind}, decoded string")


_DECODERS: dict[str, Callable[[bytes], str]] = {}


def decoder_for(vocabulary: str) -> Callable[[bytes], str]:
    """From ids, as little-endian uint32 bytes, to text."""
    if vocabulary not in _DECODERS:
        parsed = json.loads(vocabulary)
        if parsed["decoder"]:
            tokenizer = library_tokenizer(vocabulary)
            _DECODERS[vocabulary] = lambda ids: tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        else:
            names = {i: s for s, i in parsed["model"]["vocab"].items()} | {t["id"]: t["content"] for t in parsed["added_tokens"]}
            table = [names.get(i, "") for i in range(max(names) + 1)]
            _DECODERS[vocabulary] = lambda ids: " ".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    return _DECODERS[vocabulary]
