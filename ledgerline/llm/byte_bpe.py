"""Byte-level BPE encoding and decoding over Arrow batches.

``BytePairCodec`` builds a ``tokenizers`` model from a rank file: merges are
recovered from the ranks, and tokens are spelled with one printable character per
byte. Texts are cut where the split pattern always cuts (white space starts a new
piece, one space staying with the word after it), so every distinct piece of a
task is encoded once by the library and reused: the library's splitter cuts it (a
piece of letters alone is one match and goes without), its bytes are spelled as characters,
and the library's model merges them.

``encode`` returns ids as little-endian unsigned 32-bit integers in one binary
(4 bytes a token) and, if asked for, each token's character offsets in the text.
Tokens that hold part of a character's bytes share that character's offsets, and
``n_split`` counts the tokens that begin or end inside one.
With ``decoded`` the same task also decodes the ids it made, so texts go to Python once.
``decode`` spells the ids and reverses the byte table, by one gather over a flat table for all texts of
a batch; joined bytes are exact even where a token ends inside a character. ``token_texts`` gives
one string per token: a split character belongs to the token that completes it.

Defined cases: null and empty texts have no tokens; strings that look like special
tokens are ordinary text; each input row gives one row, repeated ones too; a very long text is
encoded whole, its longest pieces without being remembered; an empty table gives an empty
result; other columns pass through only where they are listed in ``keep``, whose names must
not be those of the result.
"""

from __future__ import annotations

import base64
import codecs
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import give_back, small_batches, table, text_or_empty

RANKS = "byte_bpe_50k.tiktoken"
#: Unicode White_Space, which is what \s means to the library (\x1c to \x1f are not in it).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Distinct pieces a task remembers at once; beyond it the memory is emptied and filled anew.
REMEMBERED = 250_000
#: Characters of the longest piece that is remembered.
LONG_PIECE = 64
#: Pieces that are one match of the split pattern in every version of Unicode.
LETTERS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch


def byte_characters() -> list[str]:
    """The printable character that spells each byte: itself where printable, else from U+0100 on."""
    own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    rest = [b for b in range(256) if b not in set(own)]
    return [chr(b) if b in set(own) else chr(256 + rest.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The last merge that makes ``token``: merge its bytes by lower ranks until two parts are left."""
    parts, limit = [bytes([b]) for b in token], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= limit:
            return None
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def library_spec(ranks: dict[bytes, int], pattern: str) -> str:
    """The ``tokenizers`` JSON of the rank file; its size is that of the vocabulary."""
    spell = byte_characters()
    word = lambda token: "".join(spell[b] for b in token)
    ordered = sorted(ranks, key=ranks.get)
    merges = [m for m in (merge_of(t, ranks) for t in ordered if len(t) > 1) if m]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
        "post_processor": None, "decoder": None,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                  "vocab": {word(t): ranks[t] for t in ordered}, "merges": [[word(a), word(b)] for a, b in merges]}})


class BytePairCodec:
    """The library's JSON and the flat table of what the ids spell; the library itself is opened in the task."""

    def __init__(self, spec: str, text: np.ndarray, sizes: np.ndarray):
        self.spec, self.text, self.sizes = spec, text, sizes
        self.at = np.cumsum(sizes) - sizes

    @classmethod
    def of_ranks(cls, path: str, pattern: str = public_tokenizers.PATTERN) -> BytePairCodec:
        ranks = read_ranks(path)
        spec = library_spec(ranks, pattern)
        words = [""] * (max(ranks.values(), default=-1) + 1)
        for word, rank in json.loads(spec)["model"]["vocab"].items():
            words[rank] = word
        reverse = {ord(c): chr(b) for b, c in enumerate(byte_characters())}
        text = "".join(words).translate(reverse).encode("latin-1")
        return cls(spec, np.frombuffer(text, "uint8"), np.array([len(w) for w in words], "int64"))

    def open(self):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        return Tokenizer.from_str(self.spec)

    def encoder(self, offsets: bool = False):
        """A function from a list of texts to a list of (ids, starts, ends)."""
        library, cut, memory = self.open(), re.compile(PIECES).findall, {}
        split, merge = library.pre_tokenizer.pre_tokenize_str, library.model.tokenize
        spelling = {b: c for b, c in enumerate(byte_characters()) if b != 10}

        def coded(spelled: Sequence[str]) -> bytes:
            return array("I", [token.id for word in spelled for token in merge(word)]).tobytes()

        def learned(pieces: list[str]) -> dict[str, bytes]:
            """Ids of new pieces; those of letters are spelled together, a line feed between two."""
            letters = [p for p in pieces if LETTERS(p)]
            words = "\n".join(letters).encode().decode("latin-1").translate(spelling).split("\n")
            out = {p: coded([w]) for p, w in zip(letters, words)}
            out.update((p, coded([w for w, _ in split(p)])) for p in pieces if p not in out)
            return out

        def encode(texts: Sequence[str]) -> list[tuple]:
            cuts = [cut(t) for t in texts]
            new = set().union(*cuts).difference(memory)
            if len(memory) + len(new) > REMEMBERED:
                memory.clear()
                new = set().union(*cuts)
            found = learned(list(new))
            long = {p: x for p, x in found.items() if len(p) > LONG_PIECE}
            memory.update(found)
            out = [b"".join(map(memory.__getitem__, pieces)) for pieces in cuts]
            for p in long:
                del memory[p]
            if not offsets:
                return [(x, None, None) for x in out]
            return [(x, *self.offsets(x, t)) for x, t in zip(out, texts)]

        return encode

    def offsets(self, ids: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) character of the text that each token has bytes of."""
        ends = np.cumsum(self.sizes[np.frombuffer(ids, "<u4")])
        starts = ends - self.sizes[np.frombuffer(ids, "<u4")]
        character = np.cumsum((np.frombuffer(text.encode(), "uint8") & 0xC0) != 0x80)
        return (character[starts] - 1).astype("int32"), character[ends - 1].astype("int32")

    def split_tokens(self, ids: bytes, text: bytes) -> int:
        """How many tokens begin or end inside a character."""
        inside = np.append((np.frombuffer(text, "uint8") & 0xC0) == 0x80, False)
        sizes = self.sizes[np.frombuffer(ids, "<u4")]
        ends = np.cumsum(sizes)
        return int((inside[ends - sizes] | inside[ends]).sum())

    def decode_all(self, ids: Sequence[bytes]) -> list[bytes]:
        """The bytes that each sequence of ids stands for."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = self.sizes[flat]
        ends = np.cumsum(size)
        out = self.text[np.repeat(self.at[flat] - (ends - size), size) + np.arange(int(size.sum()))].tobytes()
        last = np.concatenate([[0], ends])[np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
        return [out[a:b] for a, b in zip(last, last[1:])]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0]

    def token_texts(self, ids: bytes) -> list[str]:
        """One string per token; a character split over tokens belongs to the one that completes it."""
        step = codecs.getincrementaldecoder("utf-8")("replace")
        return [step.decode(t) for t in self.decode_all([i.tobytes() for i in np.frombuffer(ids, "<u4")])]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``most`` bytes of text, at least a row each."""
    for batch in batches:
        size = np.cumsum([0 if v is None else v for v in pa.compute.binary_length(batch.column(text)).to_pylist()])
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + most, "right")))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def encode(df: DataFrame, codec: BytePairCodec, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
           offsets: bool = False, decoded: bool = False) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``n_split`` and ``ids``; with ``offsets`` also ``starts`` and ``ends``,
    with ``decoded`` the bytes that the ids stand for."""
    taken = {"n_tokens", "n_split", "ids", *(("starts", "ends") if offsets else ()), *(("decoded",) if decoded else ())}
    if clash := taken & set(keep):
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    shared = df.sparkSession.sparkContext.broadcast((codec.spec, codec.text, codec.sizes))  # as large as the vocabulary
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("n_split", T.LongType()), T.StructField("ids", T.BinaryType())]
    if offsets:
        fields += [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("starts", "ends")]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = BytePairCodec(*shared.value)
        coded = codec.encoder(offsets)
        for batch in slices(batches, "_text", 1 << 20):
            texts = batch.column("_text").to_pylist()
            out = coded(texts)
            columns = {c: batch.column(f"_{k}") for k, c in enumerate(keep)}
            columns["n_tokens"] = pa.array([len(x[0]) // 4 for x in out], pa.int64())
            columns["n_split"] = pa.array([0 if t.isascii() else codec.split_tokens(x[0], t.encode()) for x, t in zip(out, texts)], pa.int64())
            columns["ids"] = pa.array([x[0] for x in out], pa.binary())
            if offsets:
                columns |= {c: pa.array([x[k].tolist() for x in out], pa.list_(pa.int32())) for k, c in ((1, "starts"), (2, "ends"))}
            if decoded:
                columns["decoded"] = pa.array(codec.decode_all([x[0] for x in out]), pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    source = small_batches(df).select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)], text_or_empty(f"`{text_col}`").alias("_text"))
    return source.mapInArrow(run, T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(keep, source.schema.fields)], *fields]))


def decode(df: DataFrame, codec: BytePairCodec, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for (``cast('string')`` is the text)."""
    shared = df.sparkSession.sparkContext.broadcast((codec.text, codec.sizes))  # the byte strings of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = BytePairCodec("", *shared.value).decode_all
        for batch in slices(batches, ids_col, 1 << 20):
            ids = batch.column(ids_col).to_pylist()
            decoded = pa.array([None if x is None else t for x, t in zip(ids, back([x or b"" for x in ids]))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out_col, T.BinaryType())]))


def codec_of(path: str | None = None) -> BytePairCodec:
    return BytePairCodec.of_ranks(path or public_tokenizers.path(RANKS))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), codec_of(), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "n_split")
