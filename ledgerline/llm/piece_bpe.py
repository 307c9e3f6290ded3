"""SentencePiece encoding and decoding by vectorised merge rounds.

``PieceModel`` reads the pieces and scores of a BPE model once on the driver and
turns them into flat tables: the symbol of every character, an open-addressed table
from a pair of symbols to the piece it makes, and a rank per piece by score.

``encode`` splits a text into words (white space stays in front of its word; the model
must hold no piece with a space after another character, so no merge crosses a word's
start) and encodes each distinct word that a task has not seen yet. All new words of a
batch are merged together: one flat numpy array of symbols, the least pair rank of every
word by a segmented minimum, all leftmost non-overlapping pairs of that rank merged at
once, arrays compacted, until no word has a pair left.

That equals merging one pair at a time, best score first and leftmost among equals:

* A piece is *plain* if no piece of a better rank starts or ends with it. Merging a plain
  piece cannot make a better pair, so all its places merge in one round. Of any other piece
  a round merges the leftmost place alone.
* A long word is cut into blocks for the minimum, so it does not need a round for each merge. A block merges in a round if neither block beside it
  has a better pair. No piece is longer than a quarter of a block, so what happens beyond
  those two blocks cannot reach the block's pairs first.
* Runs of spaces are cut by the longest run piece where the model's run pieces all have one
  and the same score below every other and merging takes the longest from the left.

Defined cases: null and empty texts have no ids and decode to an empty text; strings that
look like control pieces are ordinary text; characters outside the vocabulary become byte
pieces; U+2581 in a text counts as a space, as in the library; each input row gives one row,
repeated ones too; a very long text is encoded whole, its time grows with its length even
without white space; an empty table gives an empty result; only ``keep`` columns pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.byte_bpe import slices
from ledgerline.llm.common import small_batches, table, text_or_empty

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NO_PAIR = np.int32(2**31 - 1)
#: Bytes of words and their ids that a task remembers; beyond it the memory is emptied and filled anew.
REMEMBERED_BYTES = 24 << 20
#: Words of more characters are encoded whenever they come and not remembered.
LONG_WORD = 64
#: Characters merged together at most, one word at least.
HANDED = 1 << 19


class PieceModel:
    """The tables of a BPE model; small (the vocabulary's size), so they are broadcast."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.path = path
        n = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_unknown(i) or model.is_control(i) or model.is_byte(i) for i in range(n)]
        if any(model.is_unused(i) for i in range(n)) or [model.is_byte(i) for i in range(n)].count(True) != 256:
            raise ValueError("the model must have all byte pieces and no unused ones")
        probe = "ﬁ  Å\t b "
        if model.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
            raise ValueError("the model must keep texts as they are but for spaces and the one put before them")
        vocabulary = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in vocabulary):
            raise ValueError("a piece holds a space after another character")
        scores = [model.get_score(i) for i in range(n)]

        # Symbols: piece ids, then characters that only occur inside pieces, then all other characters.
        loose = sorted({c for p in vocabulary for c in p} - vocabulary.keys())
        symbols = vocabulary | {c: n + k for k, c in enumerate(loose)}
        self.known, self.pieces = n + len(loose), n
        self.symbol_of = np.arange(0x110000, dtype="int32") + np.int32(self.known)
        for c, s in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = s
        self.symbol_of[ord(" ")] = self.symbol_of[ord(SPACE)]
        self.char_of = np.zeros(self.known, "int64")  # of loose characters
        self.char_of[n:] = [ord(c) for c in loose]
        self.byte_id = np.zeros(256, "int32")
        for i in range(n):
            if model.is_byte(i):
                self.byte_id[int(pieces[i][3:5], 16)] = i

        best_first = sorted({scores[i] for i in vocabulary.values()}, reverse=True)
        order = {s: k for k, s in enumerate(best_first)}
        self.rank_of = np.full(n, NO_PAIR, "int32")
        for i in vocabulary.values():
            self.rank_of[i] = order[scores[i]]
        shared = {r for r, k in zip(*np.unique(self.rank_of[list(vocabulary.values())], return_counts=True)) if k > 1}
        pairs: dict[tuple[int, int], int] = {}
        self.plain = np.array([r not in shared for r in self.rank_of.tolist()])
        for p, i in vocabulary.items():
            for a, b in ((p[:k], p[k:]) for k in range(1, len(p))):
                if a in symbols and b in symbols:
                    pairs[symbols[a], symbols[b]] = i
                    for part in (a, b):
                        if len(part) > 1 and self.rank_of[vocabulary[part]] > self.rank_of[i]:
                            self.plain[vocabulary[part]] = False
        self.longest = max(map(len, vocabulary))
        self.block = 4 * self.longest
        self.keys, self.made = self.hashed(pairs)

        # The pattern that cuts texts into words, in which U+2581 has become a space.
        runs = [len(p) for p in vocabulary if not p.strip(SPACE)]
        longest, self.cut = max(runs, default=0), " *[^ ]+| +"
        if longest > 1 and not any(SPACE * 2 in p and p.strip(SPACE) for p in vocabulary):
            merge = lambda k: self.merged([" " * k])[0].tolist()
            last = {self.rank_of[vocabulary[SPACE * k]] for k in runs if k > 1} == {len(best_first) - 1}
            if last and all(merge(k) == merge(longest) + merge(k - longest) for k in range(longest + 1, 4 * longest)):
                self.cut = f" {{{longest}}}(?= )|" + self.cut

        # What each id spells.
        spelled = [b"" if model.is_control(i) else bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode()
                   for i, p in enumerate(pieces)]
        self.text = np.frombuffer(b"".join(spelled), "uint8")
        self.text_len = np.array([len(x) for x in spelled])
        self.text_at = np.cumsum(self.text_len) - self.text_len
        self.leads = np.array([p.startswith(SPACE) for p in pieces])  # may be the space put before the text
        self.odd = np.array([model.is_unknown(i) or model.is_control(i) for i in range(n)])
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])

    @staticmethod
    def slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype("int64")

    @classmethod
    def hashed(cls, pairs: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray]:
        """An open-addressed table, at most an eighth full: keys and the pieces they make."""
        bits = max(4, (8 * len(pairs)).bit_length())
        keys, made = np.full(1 << bits, -1, "int64"), np.full(1 << bits, -1, "int32")
        names = np.array([(a << 22) | b for a, b in pairs], "int64")
        for key, at, piece in zip(names.tolist(), cls.slot(names, bits).tolist(), pairs.values()):
            while keys[at] != -1:
                at = (at + 1) & ((1 << bits) - 1)
            keys[at], made[at] = key, piece
        return keys, made

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, -1 where none."""
        keys = (left.astype("int64") << 22) | right
        at = self.slot(keys, len(self.keys).bit_length() - 1)
        found = self.keys[at]
        out = np.where(found == keys, self.made[at], np.int32(-1))
        more = np.flatnonzero((found != keys) & (found != -1))
        while len(more):
            at[more] = (at[more] + 1) & (len(self.keys) - 1)
            found = self.keys[at[more]]
            hit = found == keys[more]
            out[more[hit]] = self.made[at[more[hit]]]
            more = more[~hit & (found != -1)]
        return out

    def merged(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after merging, and each word's number of them."""
        lengths = np.fromiter(map(len, words), "int64", len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        sym = self.symbol_of[points]
        ends = np.cumsum(lengths)
        word = np.repeat(np.arange(len(words), dtype="int32"), lengths)
        # Blocks of ``block`` characters; the last of a word takes the rest, so it has at least as many.
        blocks = np.maximum(lengths // self.block, 1)
        first = np.cumsum(blocks) - blocks
        inside = np.arange(len(sym)) - np.repeat(ends - lengths, lengths)
        block = (np.repeat(first, lengths) + np.minimum(inside // self.block, np.repeat(blocks - 1, lengths))).astype("int32")
        done = np.full(len(sym), -1, "int32")
        at = np.arange(len(sym))
        made = np.full(len(sym), -1, "int32")
        if len(sym) > 1:
            made[:-1] = np.where(word[1:] == word[:-1], self.join(sym[:-1], sym[1:]), -1)
        rank = np.where(made < 0, NO_PAIR, self.rank_of[made])
        del points, inside

        while len(at):
            of = block[at]
            starts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
            sizes = np.diff(starts, append=len(of))
            least = np.minimum.reduceat(rank, starts)
            own = word[at[starts]]  # the word of each block
            alone = np.ones(len(own), bool)
            beside = own[1:] == own[:-1]
            alone[1:] &= ~beside
            alone[:-1] &= ~beside
            over = alone & (least == NO_PAIR)
            live = least != NO_PAIR
            tied = np.zeros(len(own), bool)
            if beside.any():
                live[1:] &= ~beside | (least[1:] <= least[:-1])
                live[:-1] &= ~beside | (least[:-1] <= least[1:])
                tied[1:] = beside & (least[1:] == least[:-1])
                many = np.flatnonzero(~alone)
                heads = np.concatenate([[0], np.flatnonzero(own[many][1:] != own[many][:-1]) + 1])
                rest = np.minimum.reduceat(least[many], heads) == NO_PAIR
                over[many] = np.repeat(rest, np.diff(heads, append=len(many)))
            if over.any():  # finished words leave
                gone = np.repeat(over, sizes)
                done[at[gone]] = sym[gone]
                stay = ~gone
                at, sym, rank, made = at[stay], sym[stay], rank[stay], made[stay]
                keep = ~over
                least, live, tied, sizes, alone = least[keep], live[keep], tied[keep], sizes[keep], alone[keep]
                if not len(at):
                    break
            pick = np.flatnonzero(rank == np.repeat(np.where(live, least, np.int32(-1)), sizes))
            # Runs of overlapping pairs: from a run's start every second one merges; a run that goes on
            # from a block that waits has to wait as well.
            starts_run = np.ones(len(pick), bool)
            starts_run[1:] = np.diff(pick) != 1
            ok = np.ones(len(pick), bool)
            if not (starts_run.all() and alone.all()):
                run = np.cumsum(starts_run) - 1
                head = np.flatnonzero(starts_run)
                before = pick[head] - 1
                waits = (before >= 0) & (rank[before] == rank[pick[head]])
                ok = ((np.arange(len(pick)) - head[run]) % 2 == 0) & ~waits[run]
            # Of pieces that are not plain only the leftmost place of the block, if the block before has no equal one.
            strict = ~self.plain[made[pick]]
            if strict.any():
                home = np.repeat(np.arange(len(sizes)), sizes)[pick]
                leftmost = np.ones(len(pick), bool)
                leftmost[1:] = home[1:] != home[:-1]
                ok &= ~strict | (leftmost & ~tied[home])
            pick = pick[ok]
            sym[pick] = made[pick]
            stay = np.ones(len(at), bool)
            stay[pick + 1] = False
            at, sym, rank, made = at[stay], sym[stay], rank[stay], made[stay]
            new = pick - np.arange(len(pick))
            touched = np.concatenate([new, new[new > 0] - 1])
            right = np.minimum(touched + 1, len(at) - 1)
            joined = self.join(sym[touched], sym[right])
            joined[(touched == len(at) - 1) | (word[at[touched]] != word[at[right]])] = -1
            made[touched] = joined
            rank[touched] = np.where(joined < 0, NO_PAIR, self.rank_of[joined])
        kept = done >= 0
        return done[kept], np.add.reduceat(kept, ends - lengths, dtype="int64") if len(words) else np.zeros(0, "int64")

    def ids(self, sym: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids for symbols: characters that are no pieces become the byte pieces of their UTF-8."""
        whole = sym < self.pieces
        if whole.all():
            return sym, counts
        points = np.where(sym < self.known, self.char_of[np.minimum(sym, self.known - 1)], sym - self.known)
        n = np.where(whole, 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        starts = np.cumsum(n) - n
        out = np.empty(int(n.sum()), "int32")
        out[starts[whole]] = sym[whole]
        for size, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            some = np.flatnonzero(~whole & (n == size))
            for k in range(size):
                bits = points[some] >> (6 * (size - 1 - k))
                out[starts[some] + k] = self.byte_id[bits | lead if k == 0 else (bits & 0x3F) | 0x80]
        return out, np.add.reduceat(n, np.cumsum(counts) - counts)

    def encoder(self):
        """A function from a list of texts to a list of ids as bytes, 4 a token (little-endian)."""
        cut, memory, held = re.compile(self.cut).findall, {}, 0

        def encode(texts: Sequence[str]) -> list[bytes]:
            nonlocal held
            split = [cut(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
            new = list({w for words in split for w in words} - memory.keys())
            local = {}
            for some in handed(new):
                flat, counts = self.ids(*self.merged(some))
                buffer, ends = flat.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
                local.update(zip(some, map(buffer.__getitem__, map(slice, [0, *ends], ends))))
            short = {w: x for w, x in local.items() if len(w) <= LONG_WORD}
            held += sum(map(len, short)) + sum(map(len, short.values()))
            if held > REMEMBERED_BYTES:
                local = {w: memory[w] for words in split for w in words if w in memory} | local
                memory.clear()
                held = sum(map(len, short)) + sum(map(len, short.values()))
            memory.update(short)
            if len(short) == len(local):
                return [b"".join(map(memory.__getitem__, words)) for words in split]
            known = lambda w: memory[w] if w in memory else local[w]
            return [b"".join(map(known, words)) for words in split]

        return encode

    def decode(self, ids: Sequence[np.ndarray]) -> list[bytes]:
        """The texts that the ids stand for, as UTF-8; what is no valid UTF-8, or holds control
        or unknown ids, is left to the library's decoder."""
        flat = np.concatenate(ids) if len(ids) else np.zeros(0, "int32")
        n = np.array([len(x) for x in ids], "int64")
        size = self.text_len[flat]
        from_at = self.text_at[flat]
        ends = np.cumsum(size)
        text = self.text[np.repeat(from_at - (ends - size), size) + np.arange(int(size.sum()))].tobytes()
        last = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])].tolist()
        odd, byte = self.odd[flat], self.is_byte[flat]
        out, start, library = [], 0, None
        for k, count in enumerate(n.tolist()):
            a, b = last[k], last[k + 1]
            if count and self.leads[flat[start]]:
                a += 1
            got, some = text[a:b], slice(start, start + count)
            if odd[some].any() or byte[some].any() and not valid(got):
                from sentencepiece import SentencePieceProcessor

                library = library or SentencePieceProcessor(model_file=self.path)
                got = library.decode(flat[some].tolist()).encode()
            out.append(got)
            start += count
        return out


def valid(text: bytes) -> bool:
    try:
        text.decode()
    except UnicodeDecodeError:
        return False
    return True


def handed(words: list[str]) -> Iterator[list[str]]:
    """The words in parts of about ``HANDED`` characters, at least one word each."""
    part, size = [], 0
    for word in words:
        if part and size + len(word) > HANDED:
            yield part
            part, size = [], 0
        part.append(word)
        size += len(word)
    if part:
        yield part


def encode(df: DataFrame, model: PieceModel, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
           decoded: bool = False) -> DataFrame:
    """``keep`` columns and ``ids``; with ``decoded`` also the text that the ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        coded = model.encoder()
        for batch in slices(batches, "_text", 1 << 20):
            ids = [np.frombuffer(x, "<i4") for x in coded(batch.column("_text").to_pylist())]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("int32")
            arrays = [batch.column(c) for c in range(batch.num_columns - 1)]
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype("int32"))))
            if decoded:
                arrays.append(pa.array(model.decode(ids), pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in out.fields])

    # Plain names on the way in: mapInArrow does not resolve names with dots.
    source = small_batches(df).select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(keep)], text_or_empty(f"`{text_col}`").alias("_text"))
    out = T.StructType([*[T.StructField(c, f.dataType) for c, f in zip(keep, source.schema.fields)], *fields])
    return source.mapInArrow(run, out)


def decode(df: DataFrame, model: PieceModel, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text that its ids stand for; null ids give a null text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    out = T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())])
    at = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(at).to_pylist()
            texts = shared.value.decode([np.array(x or [], "int32") for x in ids])
            texts = pa.array([None if x is None else t for x, t in zip(ids, texts)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[f.name for f in out.fields])

    return small_batches(df).mapInArrow(run, out)


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"), PieceModel(public_tokenizers.path(MODEL)), decoded=True)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
