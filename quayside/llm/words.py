"""Published tokenizers applied word by word, with a bounded store of words met.

A byte-level BPE model never merges over the borders of its pretokens, and a
piece model never over a border that no piece of its vocabulary crosses.  So a
text's ids are those of its words end to end, and a word met before need not be
encoded again.  The libraries themselves encode each new word; texts are whole.

A model of another kind (with a normalizer, another splitting rule, added tokens
that take white space with them) is applied to whole texts instead.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain, compress, pairwise
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

from . import common as C
from .bpe import _SPACE_RUN, MAX_VOCAB_BYTES, PRETOKENS, Pieces, Rows, byte_letters

#: Words that a Python worker keeps encoded (about 250 bytes each).
CACHE_WORDS = 600_000
#: Letters of the plain texts below; every other character of theirs is no
#: letter, and 0-9 are their only numbers.
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile("[\t\n\r -~¡-©«-±´¶-¸»¿-ÿ‐-‧]*\\Z")
#: ``PRETOKENS`` for plain texts, in the terms of the standard library.
_PLAIN_WORDS = re.compile(f" ?[{_L}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t\n\r 0-9{_L}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")
#: Pieces that are split at a time; those of a block that is not plain, one by one.
BLOCK = 128
#: New words of letters that the library's model is given at a time.
TOGETHER = 64
#: Bytes after a space with which white space may begin.
_MAY_SPACE = np.zeros(256, bool)
_MAY_SPACE[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def pretokens(text: str) -> list[str]:
    return (_PLAIN_WORDS if _PLAIN.match(text) else PRETOKENS).findall(text)


class Words:
    """Ids of texts through a store of encoded words.  A subclass splits a text
    and encodes a list of new words."""

    def __init__(self, limit: int = CACHE_WORDS) -> None:
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.met, self.ids = Pieces(), Rows()

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words end to end and the number of each word."""
        raise NotImplementedError

    def found(self, words: list[str]) -> np.ndarray:
        """The numbers of words in the store; those not met before are encoded."""
        which = np.fromiter(map(self.met.__getitem__, words), np.int64, len(words))
        if self.met.new:
            self.ids.add(*self.fresh(self.met.new))
            self.met.new = []
        return which

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end and the number of each text."""
        if len(self.met) > self.limit:
            self.forget()
        words, count = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                split = self.split(text)
                words += split
                count[i] = len(split)
        flat, n = self.ids.gather(self.found(words))
        return flat, sums(n, count)


def end_to_end(got: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(got), np.int64), np.fromiter(map(len, got), np.int64, len(got))


def sums(n: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of neighbouring runs of ``count`` values each."""
    total, ends = np.concatenate([[0], np.cumsum(n)]), np.cumsum(count)
    return total[ends] - total[ends - count]


def _may_be_odd(column: pa.Array) -> list[int]:
    """The texts that may hold a space before white space or at their end."""
    raw, off = C.text_buffer(column)
    space = np.flatnonzero(raw == 32)
    space = space[np.append(_MAY_SPACE[raw[1:]], True)[space]] if len(space) else space
    last = np.flatnonzero((off[1:] > off[:-1]) & (raw[off[1:] - 1] == 32)) if len(raw) else space[:0]
    return np.union1d(np.searchsorted(off, space, "right") - 1, last).tolist()


def _over_words(token: bytes) -> bool:
    """Whether a token may begin in a word of letters and go on behind a space."""
    before = [token[: m.start()].decode("utf-8", "ignore")[-1:] for m in re.finditer(rb"(?<!\A) ", token)]
    return any(not c or c.isalpha() for c in before)


class ByteWords(Words):
    """A byte-level BPE file of the tokenizers library.  ``special``: the added
    tokens' strings in a text are their own ids (the library's default);
    otherwise they are plain text."""

    def __init__(self, spec: str, special: bool = True, limit: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_padding()
        self.library.no_truncation()
        self.library.encode_special_tokens = not special
        layout = json.loads(spec)
        before, added = layout.get("pre_tokenizer") or {}, layout.get("added_tokens") or []
        self.by_words = (
            layout.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word")) and (special or all(t.get("special") for t in added)))
        self.added = {t["content"]: t["id"] for t in added} if special else {}
        self.mark = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.letters = dict(enumerate(byte_letters()))
        self.points = np.array([ord(c) for c in self.letters.values()], "<u4")
        self.base = max(self.library.get_vocab(with_added_tokens=True).values()) + 1
        tokens = self.bytes_of()
        self.plain = Tokenizer(self.library.model).encode_batch_fast  # the model alone
        self.n_bytes = np.array([len(t) for t in tokens])
        model = layout["model"]
        self.joins = (
            model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "ignore_merges"))
            and set(self.letters.values()) <= set(model["vocab"]) and not any(b" " in t[1:] and _over_words(t) for t in tokens))
        super().__init__(limit)

    def bytes_of(self) -> list[bytes]:
        """The bytes that each id stands for."""
        to_byte = {c: b for b, c in self.letters.items()}
        out = [b""] * self.base
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            out[i] = bytes(to_byte[c] for c in token)
        for i, token in self.library.get_added_tokens_decoder().items():
            out[i] = token.content.encode()
        return out

    def split(self, text: str) -> list[str]:
        if self.mark is None or not self.mark.search(text):
            return pretokens(text)
        out: list[str] = []
        for i, part in enumerate(self.mark.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out += pretokens(part)
        return out

    def fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of a space and letters go to the library's model many at a time,
        end to end: no token reaches from one into the next, and the bytes of the
        tokens tell whose they are.  Others go one by one."""
        letters, added, model, space = self.letters, self.added, self.library.model.tokenize, self.letters[32]
        joined = [self.joins and w[0] == " " and w[1:].isalpha() and w not in added for w in words]
        got = []
        for w in compress(words, map(not_, joined)):
            if w in added:
                got.append([added[w]])
            elif w.isascii() and w.isprintable():
                got.append([t.id for t in model(w.replace(" ", space))])
            else:
                got.append([t.id for t in model(w.encode().decode("latin-1").translate(letters))])
        flat, n = end_to_end(got)
        raw = np.frombuffer("".join(compress(words, joined)).encode(), np.uint8)
        if not len(raw):
            return flat, n
        text, start = self.points[raw].tobytes().decode("utf-32-le"), np.flatnonzero(raw == 32)
        parts = [text[a:b] for a, b in pairwise([*start[::TOGETHER].tolist(), len(raw)])]
        coded = (e.ids for i in range(0, len(parts), TOGETHER) for e in self.plain(parts[i : i + TOGETHER], add_special_tokens=False))
        ids = np.fromiter(chain.from_iterable(coded), np.int64)
        ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.append(start[1:], len(raw)), "right")
        mine, count, begin = np.array(joined), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        count[mine], count[~mine] = np.diff(ends, prepend=0), n
        begin[mine], begin[~mine] = ends - count[mine], len(ids) + np.cumsum(n) - n
        return np.concatenate([ids, flat])[C.ranges(begin, count)], count

    def pieces(self, texts: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
        """Distinct pieces of the texts between which no pretoken reaches, first
        those that follow a space (without it), then the others; all pieces in
        order by their number among these, and how many each text has.
        A space that no white space follows begins a piece; texts that have
        another one, or an added token, are split one by one."""
        column = pa.array(texts, pa.large_string())
        odd = [i for i in _may_be_odd(column) if _SPACE_RUN.search(texts[i])]
        if self.mark is not None:
            odd = sorted({*odd, *(i for i, t in enumerate(texts) if self.mark.search(t))})
        if odd:
            plain = list(texts)
            for i in odd:
                plain[i] = ""
            column = pa.array(plain, pa.large_string())
        parts = pc.split_pattern(column, " ")
        at = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        which, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first, begin = which[at[:-1]].tolist(), len(names)  # a text's first piece follows no space
        others = Pieces()
        which[at[:-1]] = begin + np.fromiter(map(others.__getitem__, map(names.__getitem__, first)), np.int64, len(first))
        for i in first:
            if not names[i] or names[i][0].isspace():
                names[i] = "-"  # it follows no space anywhere
        count = np.diff(at)
        if odd:
            start, count, more = at[:-1].copy(), count.copy(), []
            for i in odd:
                split = self.split(texts[i])
                start[i], count[i] = len(which) + len(more), len(split)
                more += map(others.__getitem__, split)
            which = np.concatenate([which, begin + np.array(more, np.int64)])[C.ranges(start, count)]
        return names, list(others), which, count

    def words_of(self, names: list[str], others: list[str]) -> tuple[list[str], np.ndarray]:
        """The words of the pieces end to end, and how many each has.  Pieces
        that follow a space are split many at a time, end to end."""
        words: list[str] = []
        for lo in range(0, len(names), BLOCK):
            block = " " + " ".join(names[lo : lo + BLOCK])
            if _PLAIN.match(block):
                words += _PLAIN_WORDS.findall(block)
            else:
                for p in names[lo : lo + BLOCK]:
                    words += pretokens(" " + p)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        sizes = np.fromiter(map(len, names), np.int64, len(names)) + 1
        n_words = np.diff(np.searchsorted(ends, np.cumsum(sizes), "right"), prepend=0)
        split = [self.split(p) for p in others]
        words += chain.from_iterable(split)
        return words, np.concatenate([n_words, np.fromiter(map(len, split), np.int64, len(split))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_words:
            return end_to_end([self.library.encode(t, add_special_tokens=False).ids for t in texts])
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.met) > self.limit:
            self.forget()
        names, others, which, count = self.pieces(texts)
        words, n_words = self.words_of(names, others)
        flat, n = self.ids.gather(self.found(words))
        size = sums(n, n_words)
        begin = np.cumsum(size) - size
        return flat[C.ranges(begin[which], size[which])], sums(size[which], count)


class PieceWords(Words):
    """A sentencepiece model, which puts a space before each text."""

    def __init__(self, model: bytes, limit: int = CACHE_WORDS) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        self.base = self.library.get_piece_size()
        probe = "  a  éﬁ \n b "
        self.by_words = self.library.normalize(probe).replace("▁", " ") == " " + probe
        lib = self.library
        pieces = [lib.id_to_piece(i) for i in range(self.base) if not (lib.is_control(i) or lib.is_byte(i) or lib.is_unknown(i))]
        # white space begins a piece or fills it; a line break stands alone
        self.by_words &= not any(re.search("(?s)[^▁]▁|.\n|\n.", p) for p in pieces)
        # letters after which no piece goes on with anything but a letter
        out: set[str] = set()
        while True:
            no = re.escape("".join(sorted(out)))
            found = {m for p in pieces for m in re.findall(rf"([^\W\d_{no}])(?=[\W\d_{no}])", p)}
            if not found - out:
                break
            out |= found
        self.words = re.compile(rf" *[^\W\d_{no}]+| *(?:(?![ \n])[\W\d_{no}])+[^\W\d_{no}]*| +|\n")
        self.blank = lib.encode("\n")
        super().__init__(limit)

    def bytes_of(self) -> list[bytes]:
        lib = self.library
        return [bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i) else lib.id_to_piece(i).replace("▁", " ").encode() for i in range(self.base)]

    def split(self, text: str) -> list[str]:
        return self.words.findall(" " + text.replace("▁", " "))  # the library does not tell them apart

    def fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the library's own space stands for a word's first one; a word without
        # one goes behind a line break, whose ids are then left out
        got = self.library.encode([w[1:] if w[0] == " " else "\n" + w for w in words], num_threads=1)
        skip = len(self.blank)
        return end_to_end([self.blank[:1] if w == " " else ids if w[0] == " " else ids[skip:] for w, ids in zip(words, got, strict=True)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.by_words:
            return super().encode(texts)
        return end_to_end(self.library.encode(texts, num_threads=1))


_KEPT: dict[tuple, Words] = {}


def kept(kind: type[Words], spec: Broadcast, **options: bool) -> Words:
    """The encoder of a broadcast file, which a Python worker keeps over its tasks."""
    raw = spec.value if isinstance(spec.value, bytes) else spec.value.encode()
    key = (kind.__name__, zlib.crc32(raw), len(raw), *sorted(options.items()))
    if key not in _KEPT:
        _KEPT[key] = kind(spec.value, **options)
    return _KEPT[key]


def piece_model(spark: SparkSession, path: str) -> Broadcast:
    """Broadcast a sentencepiece model, whose size is checked."""
    with open(path, "rb") as f:
        model = f.read(MAX_VOCAB_BYTES + 1)
    if len(model) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path}: over {MAX_VOCAB_BYTES} bytes")
    return spark.sparkContext.broadcast(model)
