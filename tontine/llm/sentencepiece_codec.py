"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is read here; its normaliser, the metaspace mark, the pieces' scores and the
byte fallback are rebuilt for the tokenizers library, for unigram and for BPE models. Texts are cut before
each run of marks, where no piece of the model reaches across (checked when the model is read; a model
with such pieces is encoded uncut). Each batch encodes the chunks that are new to it, joined to rows of up to 2,000, one
call a row (those that can't be joined, or whose row differs, as one batch over threads), checks them against the
SentencePiece library, and puts texts together from chunks. Both sides see the text as normalised here.

Defined results: NULL counts as empty; an empty text has no ids. Any text round-trips, by bytes where the
vocabulary has no piece. Rows with the same id are encoded each for itself; texts of any length are encoded whole, by
one task each. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from tontine.llm.common import arrow_map, narrow

MARK = "▁"
# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
REMEMBERED = 400_000
_MADE: dict[str, Codec] = {}


def fields(data: bytes):
    """The fields of a protobuf message: (number, value), where the value is an int or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    unk_id: int = 0

    @classmethod
    def read(cls, data: bytes) -> Model:
        model = cls()
        for number, value in fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                model.pieces.append(piece)
                model.scores.append(score)
                model.kinds.append(kind)
            elif number == 2:
                for n, v in fields(value):
                    if n == 3:
                        model.model_type = v
                    elif n == 35:
                        model.byte_fallback = bool(v)
                    elif n == 40:
                        model.unk_id = v
            elif number == 3:
                for n, v in fields(value):
                    if n == 2:
                        model.charsmap = v
                    elif n == 3:
                        model.dummy_prefix = bool(v)
                    elif n == 4:
                        model.remove_extra = bool(v)
        return model


def rebuilt(model: Model):
    """The model as a Tokenizer."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = model.pieces[model.unk_id]
    if model.model_type == BPE:
        vocab = {p: i for i, p in enumerate(model.pieces)}
        usable = {p: i for p, i in vocab.items() if model.kinds[i] in (NORMAL, USER_DEFINED)}
        merges = []
        for piece, i in usable.items():
            for cut in range(1, len(piece)):
                if piece[:cut] in usable and piece[cut:] in usable:
                    merges.append((-model.scores[i], i, cut, piece[:cut], piece[cut:]))
        merges = [(a, b) for *_, a, b in sorted(merges)]
        core = models.BPE(vocab, merges, unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.model_type == UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores, strict=True)), model.unk_id, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.model_type} is neither unigram nor BPE")
    made = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if steps:
        made.normalizer = normalizers.Sequence(steps)
    # The mark is set before the cut into chunks; chunks come as they are.
    made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    made.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])
    )
    users = [AddedToken(p, normalized=False) for p, k in zip(model.pieces, model.kinds, strict=True) if k == USER_DEFINED]
    if users:
        made.add_tokens(users)
    return made


class Codec:
    """Encoder and decoder of one model file, with a memory of chunks."""

    CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = Model.read(file.read())
        self.tokenizer = rebuilt(self.model)
        self.path = path
        self.reference = None
        self.known: dict[str, tuple[bytes, bool]] = {}
        self.cut = not any(MARK in p.lstrip(MARK) for p in self.model.pieces) and USER_DEFINED not in self.model.kinds
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(MARK, " ").encode()
            for p, k in zip(self.model.pieces, self.model.kinds, strict=True)
        ]

    @classmethod
    def of(cls, path: str) -> Codec:
        return _MADE.get(path) or _MADE.setdefault(path, cls(path))

    def prepared(self, text: str) -> str:
        """The text as the model sees it: normalised, marked, and with its leading mark."""
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        if not text:
            return ""
        return MARK * self.model.dummy_prefix + text.replace(" ", MARK)

    def learn(self, chunks: list[str]) -> None:
        """Encode new chunks and compare each with the SentencePiece library, where a chunk's own
        leading mark is what the dummy prefix gives."""
        if self.reference is None:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_file=self.path)
        # Chunks that begin and don't end with a mark are cut apart again when put in a row.
        row = [c for c in chunks if self.cut and self.model.dummy_prefix and c[0] == MARK and c[-1] != MARK]
        rest = set(chunks).difference(row)
        for first in range(0, len(row), 2000):
            if not self.learn_row(row[first : first + 2000]):
                rest.update(row[first : first + 2000])
        if rest:
            self.learn_each(list(rest))

    def learn_row(self, chunks: list[str]) -> bool:
        """Encode chunks as one text, if the SentencePiece library gives the same ids for all of it."""
        text = "".join(chunks)
        made = self.tokenizer.encode(text, add_special_tokens=False)
        if made.ids != self.reference.encode(text.replace(MARK, " ")[1:]):
            return False
        ids = np.array(made.ids, "<u4")
        begins = np.fromiter((o[0] for o in made.offsets), np.int64, len(ids))
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        left = 0
        for chunk, right in zip(chunks, np.searchsorted(begins, ends, "left").tolist(), strict=True):
            self.known[chunk] = ids[left:right].tobytes(), True
            left = right
        return True

    def learn_each(self, chunks: list[str]) -> None:
        encoded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        lead = self.model.dummy_prefix
        plain = [c.replace(MARK, " ") for c in chunks]
        expected = self.reference.encode([p[1:] if lead and p[:1] == " " else p for p in plain], num_threads=1)
        for chunk, made, wanted in zip(chunks, encoded, expected, strict=True):
            ids = np.array(made.ids, "<u4")
            self.known[chunk] = ids.tobytes(), made.ids == wanted

    def batch(self, texts: list[str]):
        """For each text its ids as little-endian unsigned 32-bit numbers, and whether all its chunks
        are encoded alike by the SentencePiece library."""
        for text in texts:
            ready = self.prepared(text)
            chunks = (self.CHUNK.findall(ready) if self.cut else [ready]) if ready else []
            new = set(chunks).difference(self.known)
            if new:
                if len(self.known) > REMEMBERED:
                    self.known, new = {}, set(chunks)
                self.learn(list(new))
            got = [self.known[c] for c in chunks]
            yield b"".join([g[0] for g in got]), all([g[1] for g in got])

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, parity, round_trip`` (and ``ids``): the ids' number and checksum,
    whether they are those of the SentencePiece library, and whether they decode to the (normalised) text."""

    def run(columns: dict[str, list]) -> dict[str, list]:
        codec = Codec.of(model_path)
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_ids", "ids_crc32", "parity", "round_trip", "ids")}
        for key, text, (ids, same) in zip(columns["id"], columns["text"], codec.batch(columns["text"]), strict=True):
            numbers = np.frombuffer(ids, "<u4")
            whole = codec.tokenizer.normalizer.normalize_str(text) if codec.tokenizer.normalizer else text
            out["doc_id"].append(key)
            out["n_ids"].append(len(numbers))
            out["ids_crc32"].append(zlib.crc32(ids))
            out["parity"].append(same)
            out["round_trip"].append(codec.decode(numbers.tolist()) == whole)
            if with_ids:
                out["ids"].append(numbers.astype("i4"))
        return out

    schema = "doc_id long, n_ids long, ids_crc32 long, parity boolean, round_trip boolean" + ", ids array<int>" * with_ids
    return arrow_map(narrow(docs, id_col, text_col), schema, run)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of rows of ids; NULL ids give an empty text, unknown ids an error."""

    def run(columns: dict[str, list]) -> dict[str, list]:
        codec = Codec.of(model_path)
        return {"doc_id": columns["doc_id"], "text": [codec.decode(i or []) for i in columns["ids"]]}

    from pyspark.sql import functions as F

    from tontine.llm.common import ship

    ship(encoded.sparkSession)
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return arrow_map(rows, "doc_id long, text string", run)
