"""SentencePiece (merge-type) encoding and decoding with a prefix table.

For every prefix of a chunk the last token of its encoding is unique. The table holds that token: among the
pieces that an automaton finds to end at a position, it is the one that is compatible with the last token of the
prefix before it. Two tokens are compatible when merging their concatenation gives the two again; a chain of
tokens is an encoding just when all neighbours are compatible. Ids are then read backwards from the end.

Compatibility is decided by replaying the two tokens' own merges side by side and looking whether a merge across
the border would come first. Characters that no piece has stand for themselves and become byte pieces.

Where two neighbouring characters stand side by side in no piece, nothing ever merges across, so texts are cut
there (at every new word, in particular); equal parts are encoded once per slice and kept in a bounded cache.

Cases: a null or empty text has no ids and decodes to "". Repeated rows and ids are encoded row by row. Other
input columns are not touched.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SPACE = "▁"
#: Parts of which a worker keeps the ids; the cache is emptied when it is full.
CACHE = 150_000
NEVER = float("inf")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A merge-type SentencePiece model, read from its file; use one per worker."""

    _open: dict[str, "Pieces"] = {}

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.names = [model.id_to_piece(i) for i in ids]
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte_of = {i: int(self.names[i][3:5], 16) for i in ids if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.unknown = model.unk_id()
        plain = [i for i in ids if i not in special and i not in self.byte_of]
        self.id_of = {self.names[i]: i for i in plain}
        self.rank = {self.names[i]: -model.get_score(i) for i in plain}
        self.steps: dict[int, tuple[list, bool]] = {}
        self.fits: dict[int, bool] = {}
        self.cache: dict[str, tuple[str, int, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            if self.merges(i)[1]:
                self.automaton.add_word(self.names[i], (len(self.names[i]), i))
        self.automaton.make_automaton()
        pairs = {(ord(p[k]), ord(p[k + 1])) for p in self.id_of for k in range(len(p) - 1)}
        kind_of = {c: k for k, c in enumerate(sorted({c for pair in pairs for c in pair}), 1)}
        self.kinds = np.zeros(max(kind_of, default=0) + 2, np.int32)
        self.kinds[list(kind_of)] = list(kind_of.values())
        self.beside = np.zeros((len(kind_of) + 1,) * 2, bool)
        for x, y in pairs:
            self.beside[kind_of[x], kind_of[y]] = True

    def merges(self, i: int) -> tuple[list, bool]:
        """The merges that build piece i: (rank, left end, right end) after each, and whether they end in the piece."""
        if i not in self.steps:
            parts, rank = list(self.names[i]), self.rank
            steps = [(-1.0, parts[0], parts[-1])]
            while len(parts) > 1:
                best, at = min((rank.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
                if best == NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                steps.append((best, parts[0], parts[-1]))
            self.steps[i] = steps, len(parts) == 1
        return self.steps[i]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the text of both gives exactly the two."""
        key = left << 32 | right
        if (known := self.fits.get(key)) is None:
            a, b, i, j, rank = self.merges(left)[0], self.merges(right)[0], 0, 0, self.rank
            while True:
                across = rank.get(a[i][2] + b[j][1], NEVER)
                next_a = a[i + 1][0] if i + 1 < len(a) else NEVER
                next_b = b[j + 1][0] if j + 1 < len(b) else NEVER
                if across < next_a and across <= next_b:  # of equal ranks the leftmost goes first
                    known = False
                    break
                if next_a == next_b == NEVER:
                    known = True
                    break
                i, j = (i + 1, j) if next_a <= next_b else (i, j + 1)
            if len(self.fits) > 4 * CACHE:
                self.fits.clear()
            self.fits[key] = known
        return known

    def chunk_ids(self, chunk: str) -> list[int]:
        """The ids of a chunk in which spaces are space marks already."""
        n, fits, filled = len(chunk), self.fits.get, -1
        last: list[int | None] = [None] * (n + 1)
        for end, (length, i) in self.automaton.iter(chunk):
            if end != filled:
                before = last[end + 1 - length]  # None: the start, or a character without a piece
                if before is None or (good := fits(before << 32 | i)) or (good is None and self.compatible(before, i)):
                    last[end + 1], filled = i, end
        found, at = [], n
        while at:
            if (i := last[at]) is None:
                raw = chunk[at - 1].encode()
                found.extend([self.id_of_byte[b] for b in reversed(raw)] if self.id_of_byte else [self.unknown])
                at -= 1
            else:
                found.append(i)
                at -= len(self.names[i])
        return found[::-1]

    def encode(self, text: str | None) -> list[int]:
        return self.chunk_ids(SPACE + text.replace(" ", SPACE)) if text else []

    def spell(self, ids) -> str:
        """The characters of ids, space marks as spaces."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.names[i] for i in ids]).replace(SPACE, " ")
        out, raw = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.names[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids) -> str:
        text = self.spell(ids)
        return text[1:] if text[:1] == " " else text

    def known(self, part: str) -> tuple[str, int, str]:
        """A part's ids as text, their number, and what they spell."""
        if (found := self.cache.get(part)) is None:
            ids = self.chunk_ids(part)
            found = ",".join(map(str, ids)), len(ids), self.spell(ids)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[part] = found
        return found

    def borders(self, characters: np.ndarray) -> np.ndarray:
        """Marks each character that no piece has right after the character before it: nothing merges there."""
        kinds = self.kinds[np.minimum(characters, len(self.kinds) - 1)]
        out = np.ones(len(characters), bool)
        out[1:] = ~self.beside[kinds[:-1], kinds[1:]]
        return out


def encode_texts(pieces: Pieces, text: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Ids as text, number of ids and decoded text of each text."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    marked = pc.binary_join_element_wise(pc.if_else(pc.equal(text, ""), "", SPACE).cast(pa.large_string()), pc.replace_substring(text, " ", SPACE), pa.scalar("", pa.large_string()))
    sizes = pc.binary_length(marked).to_numpy(zero_copy_only=False)
    data = np.frombuffer(b"".join(pc.cast(marked, pa.large_binary()).to_pylist()), np.uint8)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cut = pieces.borders(np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32))
    starts = np.cumsum(sizes) - sizes
    cut[np.searchsorted(at, starts[sizes > 0])] = True
    edges = np.concatenate([at[cut], [len(data)]])
    parts = pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)])
    parts = parts.dictionary_encode()
    bounds = np.searchsorted(edges, np.concatenate([starts, [len(data)]]))
    found = [pieces.known(x) for x in parts.dictionary.to_pylist()]

    def joined(values, by):
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.string()).take(parts.indices)), by)

    spelt = pc.utf8_slice_codeunits(joined([x[2] for x in found], ""), 1)  # without the first space mark
    n_ids = common.per_text(np.array([x[1] for x in found], np.int64)[parts.indices.to_numpy()], bounds)
    return joined([x[0] for x in found], ","), n_ids, spelt


def encoded(docs: DataFrame, path: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """Encodes and decodes the column text of docs.

    Returns carry's columns (doc_id by default), n_tokens, ids (decimal ids joined by commas; split(ids, ',') gives
    them one by one) and decoded. path: the model file, which every worker opens; carry must not have those names.
    """
    common.small_batches(docs.sparkSession)
    path, carry = path or model_path(), carry or ["doc_id"]
    made = docs.select(F.struct(*carry).alias("row"), "text")

    def run(batches):
        pieces = Pieces.of(path)
        for batch in batches:
            for part in common.slices(batch):
                ids, sizes, spelt = encode_texts(pieces, part.column("text"))
                yield pa.RecordBatch.from_arrays([common.loose(part.column("row")), pa.array(sizes, pa.int64()), ids, spelt], ["row", "n_tokens", "ids", "decoded"])

    kind = made.schema["row"].dataType.simpleString()
    return made.mapInArrow(run, f"row {kind}, n_tokens long, ids string, decoded string").select("row.*", "n_tokens", "ids", "decoded")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encoded(common.documents(spark, sf_dir))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
