"""Published tokenizers word by word, and the operators that rest on them."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from quayside.llm import tokenfile, words

SF = "/root/testdata/sf0.01"
VOCAB = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
rnd = random.Random(5)
PARTS = [*"abXYZ  \n\t'\"#.,;:!?-_0123é漢²ªº½µ\xa0\x85\x1c​’—œßĀ한😀×÷´·\r▁<>|\x00", "<|endoftext|>", "'ll", "'ve", " the", "ing", "<0x41>", "<s>", "   "]
TEXTS = ["", " ", "\n", "  ", "a" * 30_000, " " * 5000, "é\n" * 3000, *("".join(rnd.choices(PARTS, k=rnd.randrange(60))) for _ in range(4000))]


def per_text(encoder, texts):
    flat, count = encoder.encode(texts)
    ends = np.cumsum(count)
    return [flat[a:b].tolist() for a, b in zip(ends - count, ends, strict=True)]


def library(special=True):
    t = Tokenizer.from_file(VOCAB)
    t.encode_special_tokens = not special
    return t


def test_byte_words_equal_the_library():
    with open(VOCAB, encoding="utf-8") as f:
        spec = f.read()
    for special in (True, False):
        encoder = words.ByteWords(spec, special=special, limit=500)
        assert encoder.by_words
        t = library(special)
        for i in range(0, len(TEXTS), 700):
            part = TEXTS[i : i + 700]
            assert per_text(encoder, part) == [e.ids for e in t.encode_batch(part, add_special_tokens=False)]
        encoder.by_words = False
        assert per_text(encoder, TEXTS[:50]) == [e.ids for e in t.encode_batch(TEXTS[:50], add_special_tokens=False)]
        raw = encoder.bytes_of()
        assert b"".join(raw[i] for i in t.encode(TEXTS[20], add_special_tokens=False).ids) == TEXTS[20].encode()


def test_piece_words_equal_the_library():
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(PIECES, "rb") as f:
        encoder = words.PieceWords(f.read(), limit=500)
    assert encoder.by_words
    for i in range(0, len(TEXTS), 700):
        part = TEXTS[i : i + 700]
        assert per_text(encoder, part) == lib.encode(part, num_threads=1)
    raw = encoder.bytes_of()
    assert b"".join(raw[i] for i in lib.encode("été 漢字 \x07")) == " été 漢字 \x07".encode()


def test_token_file_query_equals_the_library(spark):
    t, at = library(), 0
    found = {r.doc_id: r for r in tokenfile.op9_token_file(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert len(found) == len(docs)
    for d in docs:
        ids = [*t.encode(d.text or "", add_special_tokens=False).ids, 0]
        r = found[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_file_null_and_repeated_ids(spark, scratch):
    rows = [(7, "b c"), (None, "no id"), (7, "a"), (7, "b c"), (None, None), (3, "")]
    path = f"{scratch}/tokens"
    tokenfile.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), VOCAB, path)
    found = sorted(tokenfile.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, 3, 7, 7, 7]
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found[:-1])]).tolist()
    t = library()
    ids = lambda text: [*t.encode(text, add_special_tokens=False).ids, 0]
    assert sorted(r.ids for r in found[3:]) == sorted([ids("b c"), ids("a"), ids("b c")])
    assert sorted(r.ids for r in found[:2]) == sorted([ids("no id"), ids("")])
    # equal texts of one id are neighbours
    assert found[3].ids == found[4].ids or found[4].ids == found[5].ids


def test_grammar_with_four_byte_symbols(spark, scratch):
    rows = [(i, " ".join(rnd.choices(["aa", "bb", "cc", "dd"], k=300))) for i in range(40)]
    path = f"{scratch}/tokens"
    tokenfile.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), VOCAB, path, least=2)
    assert {r.width for r in spark.read.parquet(path).collect()} <= {2, 4}
    assert tokenfile.symbol_type(4) == "<u4"
    rules, seq = tokenfile.repair(np.array(rnd.choices(range(70_000, 70_020), k=2000)), 70_020, 2)
    raw = tokenfile._grammar({"width": 4, "lengths": tokenfile.expansion_lengths(rules, 70_020).astype("<u4").tobytes(), "rules": rules.astype("<u4").tobytes(),
                              "symbols": seq.astype("<u4").tobytes(), "base": 70_020})
    assert (raw[0] == rules).all() and (raw[2] == seq).all()


def test_spaces_and_added_tokens_equal_the_library():
    letters = [*"ab é'st1 2\n\t\r\x1c\x0b\u00a0\u2003\u200b漢.,!<|>", "  ", " \n", "<|endoftext|>", "'s", " a"]
    for special in (True, False):
        t, enc = library(special), words.ByteWords(open(VOCAB, encoding="utf-8").read(), special=special)
        for _ in range(400):
            texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 25))) for _ in range(rnd.randint(0, 5))]
            assert per_text(enc, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_a_word_is_looked_up_once_a_chunk():
    class Counted(words.Pieces):
        looked = 0

        def __getitem__(self, key):
            self.looked += 1
            return super().__getitem__(key)

    enc = words.ByteWords(open(VOCAB, encoding="utf-8").read())
    enc.met = Counted()
    enc.encode(["one two, three " * 1000 + "end"] * 3)
    assert enc.met.looked < 20


def plain_rounds(seq, base, least):
    """The rounds of the grammar, all pairs counted anew in each."""
    rules = []
    while True:
        count, doubles, i = Counter(zip(seq, seq[1:], strict=False)), Counter(), 0
        while i < len(seq) - 1:
            if seq[i] == seq[i + 1]:
                doubles[seq[i]] += 1
                i += 1
            i += 1
        heads, tails, taken, same = set(), set(), [], []
        for (a, b), n in sorted(count.items(), key=lambda x: (-x[1], x[0])):
            if n < least or a in tails or b in heads or (a == b and (a in heads or doubles[a] < least)):
                continue
            (same if a == b else taken).append((a, b))
            heads.add(a)
            tails.add(b)
        if not taken and not same:
            return rules, seq
        name = {p: base + len(rules) + i for i, p in enumerate(sorted(taken) + sorted(same))}
        rules += sorted(taken) + sorted(same)
        out, i = [], 0
        while i < len(seq):
            pair = tuple(seq[i : i + 2])
            out.append(name.get(pair, seq[i]))
            i += 2 if pair in name else 1
        seq = out


def test_later_rounds_count_only_pairs_that_can_be_frequent(monkeypatch):
    for _ in range(200):
        ids = rnd.choices(range(rnd.choice([1, 2, 3, 8, 40])), k=rnd.randint(1, 300))
        least = rnd.choice([2, 3, 8])
        rules, seq = tokenfile.repair(np.array(ids), 50, least)
        assert ([tuple(r) for r in rules.tolist()], seq.tolist()) == plain_rounds(ids, 50, least)
    ids, sizes, sort = np.random.default_rng(1).zipf(1.2, 60_000) % 5000, [], np.sort
    monkeypatch.setattr(np, "sort", lambda x, *a, **k: sizes.append(len(x)) or sort(x, *a, **k))
    tokenfile.repair(ids, 5000)
    assert sum(sizes) < 3 * len(ids)


def test_new_pieces_are_split_and_encoded_together():
    t, enc = library(), words.ByteWords(open(VOCAB, encoding="utf-8").read())
    texts = [" ".join(f"{a}{b}{c}{d}," for a in "abcdefgh" for b in "aeiou" for c in "klmnrst" for d in "éàno")] * 2
    calls = {"split": 0, "plain": 0}

    def counted(name, call):
        def run(*args, **options):
            calls[name] += 1
            return call(*args, **options)

        return run

    enc.split, enc.plain = counted("split", enc.split), counted("plain", enc.plain)
    assert per_text(enc, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert enc.joins and calls["split"] < 5 and 1 <= calls["plain"] < 5


def test_words_are_not_joined_where_a_token_goes_over_them():
    letters = words.byte_letters()
    for more, options in ((["aĠ", "aĠb"], {}), (["ba", "Ġb", "Ġba"], {"ignore_merges": True}), (["ba", "Ġb"], {})):
        vocab = {c: i for i, c in enumerate([*letters, *more])}
        merges = {"aĠ": ("a", "Ġ"), "aĠb": ("aĠ", "b"), "ba": ("b", "a"), "Ġb": ("Ġ", "b")}
        t = Tokenizer(models.BPE(vocab, [merges[m] for m in more if m in merges], **options))
        t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        enc = words.ByteWords(t.to_str())
        assert enc.by_words and enc.joins == (more == ["ba", "Ġb"])
        texts = ["a a ba bab b", " ba ba aa b", "b"]
        assert per_text(enc, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_texts_that_begin_and_end_with_white_space():
    t, enc = library(), words.ByteWords(open(VOCAB, encoding="utf-8").read())
    texts = ["a b\n", "\tx y", "", " z", "c\u00a0", "\u3000d e\u2003", "f ", "g \u2028h", "x b\n c", "\n", "\x1c \x1c", "i \x85"]
    assert per_text(enc, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_a_round_looks_only_at_places_that_can_be_frequent(monkeypatch):
    ids, sizes, either = np.random.default_rng(1).zipf(1.2, 60_000) % 5000, [], tokenfile._either
    monkeypatch.setattr(tokenfile, "_either", lambda left, *a: sizes.append(len(left)) or either(left, *a))
    tokenfile.repair(ids, 5000)
    assert len(sizes) > 5 and sum(sizes) < 3 * len(ids)


def test_pairs_too_wide_for_one_number_are_sorted_alike():
    left, right = (np.array(rnd.choices(range(30), k=500)) for _ in range(2))
    at = np.flatnonzero(np.ones(500))
    for wide in (5, 28):
        pairs, places = tokenfile._sorted_pairs(left, right, at, wide, 9)
        assert [(p >> wide, p & ((1 << wide) - 1), q & 511) for p, q in zip(pairs.tolist(), places.tolist(), strict=True)] == sorted(zip(left, right, at, strict=True))
