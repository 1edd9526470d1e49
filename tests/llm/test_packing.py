"""Packing: exact round trip of the ids, window rules, edge cases."""

import random
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from storeledger.llm import packing as P

TEXTS = [
    "", None, "One two", "the the THE", "I'm don't rock'n'roll 'S he'LL 12a3", "<|endoftext|>x a<|b|> y<|startoftext|>",
    "é ́a ΑΣ ΣΑΣ İI ǅ ß", "日本語 テスト😀😀", "a\x85b\xa0c\x1cd e", "x.,y ..z,, (a)b [c]{d} *** !!", "\n\t \r\x0b\x0c a\r\nb",
    "word " * 9000, "z" * 5000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.tokenizer_path())


def test_ids_are_the_tokenizers(tokenizer):
    ids = P.WordIds(P.tokenizer_path())
    rng = random.Random(7)
    letters = "aAbBéÉßÿ'<|>.,-_ \n\t12½µİΣςʼn\x85\xa0\x1c😀日"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(14))) for _ in range(3000)]
    for text in [t or "" for t in TEXTS] + made:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids(text), "<u4").tolist() == want, repr(text)


def test_ids_beyond_the_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 3)
    monkeypatch.setattr(P, "_remembered", {})
    ids = P.WordIds(P.tokenizer_path())
    for text in ["a b c d e f a b", "g h a", "a b c"]:
        assert np.frombuffer(ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip(spark, tokenizer):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS * 3)] + [(None, "no id", 1), (0, "again", 1)]
    pieces = P.pack(spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"]) > 0
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for i, text in enumerate(TEXTS * 3):
        if i:
            own = sorted(by_doc[i], key=lambda p: p["start"])
            want = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
            assert np.frombuffer(b"".join(p["ids"] for p in own), "<u4").tolist() == want
            assert [p["start"] for p in own] == list(np.cumsum([0] + [p["length"] for p in own])[:-1])
            assert {p["doc_tokens"] for p in own} == {len(want)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        sizes = [p["length"] for p in own]
        assert [p["offset"] for p in own] == list(np.cumsum([0] + sizes)[:-1])
        assert sum(sizes) == P.WINDOW or sum(sizes).bit_count() == 1


def test_sum_of_squares_takes_the_least():
    """Every placement is the best of all possible ones."""
    rng = random.Random(1)
    packer = P.SumOfSquares(16)
    levels = []
    for _ in range(300):
        size = rng.randrange(1, 17)
        before = list(levels)
        full = packer.place((size,), size)
        best = min(
            sum((before + [0] * (level == 0)).count(0) * 0 + c * c for c in _counts(before, level, size))
            for level in {0, *before} if level + size <= 16
        )
        levels = [level for level in range(1, 16) for _ in range(packer.counts[level])]
        assert sum(c * c for c in packer.counts[1:16]) == best
        assert full is None or sum(p[0] for p in full) == 16


def _counts(levels, level, size):
    levels = list(levels)
    if level:
        levels.remove(level)
    if level + size < 16:
        levels.append(level + size)
    return [levels.count(x) for x in set(levels)]


def test_no_rows(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def placed(rng, documents, window=4096):
    packer, full = P.SumOfSquares(window), 0
    for i in range(documents):
        size = min(window, max(1, int(rng.lognormvariate(5.5, 1.2))))
        full += size
        packer.place((i, 0, bytes(4 * size), size), size)
    return packer, full


@pytest.mark.parametrize("documents,most", [(1000, 0.1), (3000, 0.06), (10000, 0.03)])
def test_few_tokens_are_dealt_anew(documents, most):
    """Windows stay as sum-of-squares placed them, but for what tops them up: a bounded share of all tokens."""
    packer, tokens = placed(random.Random(4), documents)
    windows = packer.windows()
    before = [[piece[:2] + (len(piece[2]),) for piece in w] for w in windows]
    out = list(P.topped_up(windows, 4096))
    after = {tuple(piece[:2] + (len(piece[2]),) for piece in w[: len(b)]) for w, b in zip(out, before)}
    stayed = sum(size // 4 for b in before if tuple(b) in after for _, _, size in b)
    moved = sum(size // 4 for b in before for _, _, size in b) - stayed
    assert moved <= most * tokens
    sizes = [sum(len(ids) // 4 for _, _, ids, _ in w) for w in out]
    assert all(n == 4096 for n in sizes if n not in [1 << i for i in range(12)])
    assert sum(sizes) == sum(size // 4 for b in before for _, _, size in b)


def test_topped_up_keeps_every_id():
    rng = random.Random(2)
    for _ in range(300):
        windows, pieces = [], []
        for w in range(rng.randrange(6)):
            content = []
            for _ in range(rng.randrange(1, 4)):
                size = rng.randrange(1, 6)
                content.append((len(pieces), 0, rng.randbytes(4 * size), size))
                pieces.append(content[-1][2])
            windows.append(content)
        windows = [w for w in windows if sum(len(p[2]) // 4 for p in w) < 16]
        kept = {p[0] for w in windows for p in w}
        windows.sort(key=lambda w: -sum(len(p[2]) for p in w))
        found = defaultdict(dict)
        for content in P.topped_up(windows, 16):
            size = sum(len(p[2]) // 4 for p in content)
            assert size == 16 or size.bit_count() == 1
            for doc, start, ids, _ in content:
                assert ids and start not in found[doc]
                found[doc][start] = ids
        assert set(found) == kept
        for doc, parts in found.items():
            assert b"".join(parts[s] for s in sorted(parts)) == pieces[doc]
            assert sorted(parts) == list(np.cumsum([0] + [len(parts[s]) // 4 for s in sorted(parts)])[:-1])


def test_remembered_pieces_are_bounded(monkeypatch):
    """Ids stay right when a worker forgets; the number and the length of what it keeps are bounded."""
    monkeypatch.setattr(P, "REMEMBERED", 50)
    monkeypatch.setattr(P, "_remembered", {})
    word_ids = P.WordIds(P.tokenizer_path())
    texts = [" ".join(f"word{i * 7 + j} the" for j in range(20)) + " " + "x" * 1000 for i in range(20)]
    texts.append(" ".join(f"all{j}" for j in range(200)))
    for text in texts:
        want = word_ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(word_ids(text), "<u4").tolist() == want
        assert len(word_ids.known) <= 50 and max(map(len, word_ids.known), default=0) <= P.LONGEST
    assert any(piece.startswith("all") for piece in word_ids.known)  # of what is met last


def test_frequent_pieces_outlive_rare_ones(monkeypatch):
    """A piece that every text has is never forgotten, however many others come and go."""
    monkeypatch.setattr(P, "REMEMBERED", 20)
    monkeypatch.setattr(P, "_remembered", {})
    word_ids = P.WordIds(P.tokenizer_path())
    for i in range(200):
        word_ids(f"the word{i}of")
        assert "the" in word_ids.known or "the" in getattr(word_ids, "older", {})
        assert len(word_ids.known) + len(word_ids.older) <= 20


def test_runs_of_letters_have_the_tokenizers_ids():
    word_ids = P.WordIds(P.tokenizer_path())
    assert word_ids.plain
    texts = ["", "ABC abc", "don't I'LL x's áb's 's 're's", "É b ß ſ K İ ǅ ﬁ", "ab<|startoftext|>cd", "a_b 12ab34", "onntshansh " * 3]
    for text in texts * 2:
        want = word_ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(word_ids(text), "<u4").tolist() == want


def test_other_tokenizers_get_letters_by_themselves():
    """One that changes letters, or cuts runs of them, or has such a token of its own, is not passed by."""
    from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers, pre_tokenizers

    def made():
        return Tokenizer(models.BPE({c: i for i, c in enumerate("abc")}, []))

    plain, changed, cut, own = made(), made(), made(), made()
    changed.normalizer = normalizers.Replace("a", "b")
    cut.pre_tokenizer = pre_tokenizers.Split(Regex("c"), "removed")
    own.add_tokens([AddedToken("abc")])
    assert [P._takes_letters_as_they_are(t) for t in (plain, changed, cut, own)] == [True, False, False, False]


def test_runs_of_latin_letters_go_to_the_model(tokenizer, monkeypatch):
    """The tokenizer's whole batch call, once for each new word with an accent, was a quarter of the time."""
    ids = P.WordIds(P.tokenizer_path())
    monkeypatch.setattr(ids, "known", {})
    monkeypatch.setattr(ids, "older", {})
    words = [a + b + c for a in "eßñ" for b in P._SMALL_LATIN for c in ("zu", "çèê", "")]
    words += ["s", "ÿ", "l'été", "naïve9", "ÀÉ", "œuvre", "e\u0301", "Straße", "日本", ""]
    asked, tokenizer_of = [], ids.tokenizer

    class Counted:
        def encode(self, piece, **options):
            asked.append(piece)
            return tokenizer_of.encode(piece, **options)

    ids.tokenizer = Counted()
    for word in words:
        assert np.frombuffer(ids(word), "<u4").tolist() == tokenizer.encode(word, add_special_tokens=False).ids
    assert not any(set(piece) <= set(P._SMALL_LATIN) for piece in asked if piece)


def test_latin_letters_that_a_tokenizer_changes():
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    def made(cut, normalizer=None):
        tokenizer = Tokenizer(models.BPE())
        tokenizer.pre_tokenizer = cut
        if normalizer:
            tokenizer.normalizer = normalizer
        return P._letters_taken(tokenizer, P._SMALL_LATIN)

    by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    assert made(by_bytes)[:3] == ["a", "b", "c"] and made(by_bytes)[-1] == "Ã¿"
    assert made(by_bytes, normalizers.NFD()) == []
    assert made(pre_tokenizers.Split("é", "isolated")) == []
    assert made(pre_tokenizers.ByteLevel(add_prefix_space=True, use_regex=False)) == []
