"""Token ids of texts by the tokenizers library, each distinct chunk between spaces encoded once.

Where a tokenizer drops white space and looks at nothing across it (:func:`splits_at_space` reads that from
its file), a text's ids are those of its chunks in order.  Chunks of one group of texts are put in a
dictionary; chunks of letters between punctuation are taken apart, and the lower-cased letters go to the
tokenizer's own model, all others go through the whole tokenizer.  With any other tokenizer whole texts are
encoded.  Either way the ids are what the library gives for the whole text.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .textmap import map_text_groups, ragged_index, split_words

#: Bytes of text whose chunks share a dictionary, words whose ids a worker remembers, and words in a line for the library.
GROUP_BYTES, REMEMBERED, LINE = 8 << 20, 750_000, 64
#: The normaliser's steps and the pre-tokenizer's pattern with which chunks between spaces are independent.
NORMALIZERS = {"NFC", "Lowercase", "Replace"}
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Punctuation, letters, punctuation: ASCII and Latin-1 letters, which NFC leaves as they are.  An apostrophe
#: or an angle bracket in front could begin a contraction or a special token.
PLAIN = r"^(?P<lead>[!-&(-/:;=-@\[-`{-~]*)(?P<word>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<trail>[!-/:-@\[-`{-~]*)$"
END_OF_WORD = "</w>"


def splits_at_space(spec: dict) -> bool:
    """Does a tokenizer's file say that chunks between white space are tokenized independently?"""
    norm, pre, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
    steps = norm.get("normalizers", [])
    replaced = [s for s in steps if s["type"] == "Replace"]
    split = (pre.get("pretokenizers") or [{}])[0]
    return (
        {s["type"] for s in steps} <= NORMALIZERS
        and any(s["type"] == "Lowercase" for s in steps)
        and all(s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in replaced)
        and [p["type"] for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]
        and (split["pattern"], split["behavior"], split["invert"]) == ({"Regex": PATTERN}, "Removed", True)
        and model["type"] == "BPE"
        and model.get("end_of_word_suffix") == END_OF_WORD
        and not model.get("dropout")
        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
    )


class Encoder:
    """Ids of many texts at once; one per Python worker and tokenizer."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_str(spec)
        self.full.no_truncation()
        self.full.no_padding()
        parsed = json.loads(spec)
        self.chunks = splits_at_space(parsed)
        if self.chunks:
            self.words = Tokenizer(self.full.model)
            self.words.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            vocab = parsed["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(END_OF_WORD)]] = True
            base = pre_tokenizers.ByteLevel.alphabet()
            self.chunks = all(c in vocab and c + END_OF_WORD in vocab for c in base)  # else unknown bytes leave no id
        self.forget()

    def forget(self) -> None:
        """Drop the remembered words: their numbers, and the ids of all of them, one after another."""
        self.known: dict[str, int] = {}
        self.ids, self.stop = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.full.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def _letters(self, words: list[str]) -> np.ndarray:
        """The remembered words' numbers of distinct words of lower-case letters; new ones are encoded."""
        got = list(map(self.known.get, words))
        new = [w for w, k in zip(words, got) if k is None]
        if self.known and len(self.known) + len(new) > REMEMBERED:
            self.forget()
            got, new = [None] * len(words), words
        if new:
            lines = self.words.encode_batch_fast([" ".join(new[i : i + LINE]) for i in range(0, len(new), LINE)], add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, "<u4") for e in lines])
            stop = np.flatnonzero(self.ends[ids]) + 1
            first = len(self.known)
            self.known.update(zip(new, range(first, first + len(stop)), strict=True))
            self.stop = np.concatenate([self.stop, len(self.ids) + stop])
            self.ids = np.concatenate([self.ids, ids])
            more = iter(range(first, first + len(stop)))
            got = [next(more) if k is None else k for k in got]
        return np.array(got, np.int64)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)``: the ids of all texts, and how many each has.  None counts as empty."""
        raw = [x or b"" for x in texts]
        if not self.chunks:
            done = self._whole([x.decode("utf-8", "replace") for x in raw])
            return np.frombuffer(b"".join(done), "<u4"), np.array([len(x) // 4 for x in done], np.int64)
        data, ends, counts = split_words(raw)
        if not len(ends):
            return np.zeros(0, "<u4"), np.zeros(len(raw), np.int64)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        try:
            chunk = pc.utf8_rtrim(every.dictionary.cast(pa.large_string()), " ")
        except pa.ArrowInvalid:  # not UTF-8
            chunk = pa.array([x.as_py()[:-1].decode("utf-8", "replace") for x in every.dictionary], pa.large_string())
        parts = pc.extract_regex(chunk, PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        atoms: list[bytes] = [b""]
        index = np.zeros((len(chunk), 3), np.int64)
        odd = chunk.filter(pa.array(~plain)).to_pylist()
        index[~plain, 0] = len(atoms) + np.arange(len(odd))
        if odd:
            atoms += self._whole(odd)
        good = parts.filter(pa.array(plain))
        for k, name in ((0, "lead"), (2, "trail")):
            part = good.field(name).dictionary_encode()
            index[plain, k] = len(atoms) + part.indices.to_numpy().astype(np.int64)
            if len(part.dictionary):
                atoms += self._whole(part.dictionary.to_pylist())
        part = pc.utf8_lower(good.field("word")).dictionary_encode()
        numbers = self._letters(part.dictionary.to_numpy(zero_copy_only=False).tolist())
        index[plain, 1] = len(atoms) + numbers[part.indices.to_numpy()]
        # The atoms' ids, then the remembered words'.
        stop = np.concatenate([np.cumsum(np.fromiter(map(len, atoms), np.int64, len(atoms))) // 4, self.stop[1:]])
        stop[len(atoms) :] += stop[len(atoms) - 1]
        size = np.diff(stop, prepend=0)
        of_atoms = np.concatenate([np.frombuffer(b"".join(atoms), "<u4"), self.ids])
        if len(self.known) > REMEMBERED or len(self.ids) > 16 * REMEMBERED:
            self.forget()
        flat = index.ravel()
        ids = of_atoms[ragged_index((stop - size)[flat], size[flat])]  # of the distinct chunks
        size = size[index].sum(axis=1)
        start = np.cumsum(size) - size
        at = every.indices.to_numpy().astype(np.int64)
        before = np.concatenate([[0], np.cumsum(size[at])])
        stop = np.cumsum(counts)
        return ids[ragged_index(start[at], size[at])], before[stop] - before[stop - counts]


_ENCODERS: dict[str, Encoder] = {}


def width(spec: str) -> int:
    """Bytes that an id of the tokenizer takes: 2 or 4."""
    parsed = json.loads(spec)
    top = max([*parsed["model"]["vocab"].values(), *(t["id"] for t in parsed.get("added_tokens", []))])
    return 2 if top < 1 << 16 else 4


def read_spec(spark: SparkSession, path: str) -> str:
    """The tokenizer's file, read through Spark where it isn't on the driver's disk."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()[0]
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenised(docs: DataFrame, tokenizer: str, text: str = "text", carry: list[str] | None = None, end_id: int | None = 1) -> DataFrame:
    """``struct carry``, ``ids`` (binary, little-endian, two bytes an id or four) and ``n_tokens`` of every row.

    ``end_id`` comes after each text's ids (None: nothing does).  Null counts as empty; an empty text has the
    end id alone; repeated rows stay repeated; an empty table gives an empty one.  Extra columns travel
    inside carry.  A very long text is encoded whole, alone in its group.
    """
    spec = read_spec(docs.sparkSession, tokenizer)
    size = max(width(spec), 2 if end_id is None or end_id < 1 << 16 else 4)
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # one file of a few MB

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, Encoder(shared.value))

        def group(raws):
            ids, counts = encoder.encode(raws)
            if end_id is not None:
                stop = np.cumsum(counts)
                ids, counts = np.insert(ids, stop, end_id), counts + 1
            offsets = np.concatenate([[0], np.cumsum(counts * size)]).astype(np.int32)
            data = np.ascontiguousarray(ids, f"<u{size}")
            binary = pa.BinaryArray.from_buffers(pa.binary(), len(raws), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            return [binary, pa.array(counts, pa.int64())]

        return group

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    out = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])
    return map_text_groups(docs, text, out, make, carry, GROUP_BYTES)
