"""Encoding, packing, token files, token counts, decontamination: exact round trips and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpus_audit.llm import binary, decontaminate, packing, token_counts
from corpus_audit.llm.encoding import WordEncoder

WORD = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, ids string, sequence_id int, score double"

ODD = [
    None, "", "  \n\t ", "Hello, World!! it's 42.", "Straße ÉCOLE naïve ﬁ Ǆ İstanbul ΟΔΟΣ", "á ẖ H̱ ́x",
    "<|endoftext|> a<|ENDOFTEXT|>b <|startoftext|>", "x y z\u0085w\x1cq", "don't we'll I'M '' '.,", "日本語 テキスト 🙂🙂 .., ,.a",
    "www.a-b.com/?q=1&r=[2]", "ТЕКСТ на русском", "​zero‍ width", "A" * 5000 + " " + "b, " * 3000,
]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "clash", 7, 0.5) for i, t in rows], DOCS)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_encode_like_whole_texts():
    tokenizer, rng = Tokenizer.from_file(WORD), random.Random(7)
    alphabet = "abcXYZéÉßñÑ .,'’!?0129-\n\ṯ́İΣς<|>日🙂"
    texts = [t or "" for t in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for limit in (500_000, 3):
        got = WordEncoder(WORD, limit).encode([t.encode() for t in texts])
        for text, ids in zip(texts, got):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text), repr(text)


def test_letters_and_punctuation_skip_the_whole_encoding():
    """A word of ASCII or Latin letters, in any case and with punctuation behind it, needs only the model."""

    class Model:
        normalizer = property(lambda self: pytest.fail("normalised"))

        def encode(self, text, add_special_tokens):
            return pytest.fail(f"encoded {text!r}")

    texts = ["Straße!! Ñandú, éCOLE*** hello### HELLO$$$ ça. œuvre", "".join(f"{chr(c)}a{chr(c)} " for c in range(0xC0, 0x180) if c not in (0xD7, 0xF7, 0x130))]
    encoder = WordEncoder(WORD)
    encoder.encode([b"!! , *** ### $$$ ."])  # punctuation is encoded as it is, once
    tokenizer, encoder.words.tokenizer = encoder.words.tokenizer, Model()
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)


def test_packing_places_every_piece_once(spark):
    tokenizer = Tokenizer.from_file(WORD)
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (None, "no id"), (99, "tie one"), (98, "tie two")]
    out = packing.pack(documents(spark, rows), WORD, capacity=64).collect()
    want = sorted(
        ((i if i is not None else -1), k, a, np.array(ids[a : a + 64], "<u4").tobytes())
        for i, t in rows
        for ids in [ids_of(tokenizer, t) + [0]]
        for k, a in enumerate(range(0, len(ids), 64))
    )
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.piece, r.start, bytes(r.ids)) for r in out)
    assert got == want
    bins = {}
    for r in out:
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        assert [a for a, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]] and sum(n for _, n in places) <= 64


def one_by_one(lengths, capacity):
    """The same method, a bin at a time and without any table."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        own, gap = [], capacity
        for x in list(left):
            if x <= gap:
                own.append(x)
                left.remove(x)
                gap -= x
        if gap and len(own) > 1:
            small = own[-1]
            pairs = [(a + b, a) for i, a in enumerate(left) for b in left[i + 1 :] if small < a + b <= gap + small]
            if pairs:
                total, a = max(pairs)
                own.remove(small)
                left.append(small)
                for x in (a, total - a):
                    own.append(x)
                    left.remove(x)
                left.sort(reverse=True)
        bins.append(sorted(own, reverse=True))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_bins_are_those_of_packing_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 40])
    lengths = [rng.randint(1, capacity) if seed % 2 else max(1, int(rng.gauss(capacity / 3, capacity / 8))) for _ in range(120)]
    lengths = [min(x, capacity) for x in lengths]
    bins = packing.best_two_fit_bins(np.bincount(lengths, minlength=capacity + 1))
    flat = [sorted((s for s, n in used for _ in range(n)), reverse=True) for used, k in bins for _ in range(k)]
    assert sorted(flat) == sorted(one_by_one(lengths, capacity))


def test_two_documents_replace_the_smallest():
    # 6 + 3 leaves 1; 2 + 2 fit the widened gap of 4 exactly
    assert packing.best_two_fit_bins(np.bincount([6, 3, 2, 2], minlength=11))[0] == ([(6, 1), (2, 2)], 1)


def test_packing_of_nothing_and_of_wrong_lengths(spark):
    assert packing.pack(documents(spark, []), WORD).collect() == []
    wrong = spark.createDataFrame([(1, 0, 99)], "doc_id long, piece int, length long")
    with pytest.raises(ValueError):
        packing.best_two_fit(wrong, capacity=10)


def test_token_files_round_trip(spark, tmp_path):
    tokenizer = Tokenizer.from_file(WORD)
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(9, "repeated"), (9, "repeated"), (None, "no id"), (-5, "first")]
    folder = f"file://{tmp_path}/tokens"
    binary.write_token_files(documents(spark, rows).repartition(3), folder, WORD, end_id=2, sample_docs=5)
    got = sorted(binary.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (i, t) in zip(got, order, strict=True):
        ids = ids_of(tokenizer, t) + [2]
        assert (r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (i, start, len(ids), ids)
        start += len(ids)
    for f in spark.read.parquet(f"{folder}/manifest").collect():
        for i in (9, 12):
            try:
                assert binary.read_document(folder, f.file, i) in [ids_of(tokenizer, t) + [2] for k, t in rows if k == i]
                break
            except KeyError:
                pass
    (tmp_path / "tokens" / "dictionary").write_bytes(b"another")
    with pytest.raises(Exception, match="another dictionary"):
        binary.read_token_files(spark, folder).collect()


def test_token_files_of_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    binary.write_token_files(documents(spark, []), folder, WORD, end_id=2)
    assert binary.read_token_files(spark, folder).collect() == []


def test_trie_counts_match_every_segmentation(spark):
    scores = {p: -s for p, s in {"▁": 30, "a": 50, "b": 52, "ab": 60, "▁a": 55, "ba": 61, "aba": 90, "▁ab": 70, "é": 40}.items()}

    def best(word):
        if not word:
            return (0, 0)
        options = [(-25_000_000 * len(word[0].encode()), len(word[0].encode()), word[1:])]
        options += [(s, 1, word[len(p) :]) for p, s in scores.items() if word.startswith(p)]
        found = []
        for s, n, rest in options:
            a, b = best(rest)
            found.append((s + a, -(n) + b))
        return max(found)

    rng = random.Random(3)
    words = {"▁" + "".join(rng.choice("abéz") for _ in range(rng.randint(0, 8))) for _ in range(300)}
    got = token_counts.TrieCounter(scores).counts(words)
    assert got == {w: -best(w)[1] for w in words}
    rows = [(1, "ab ab\taba"), (2, None), (3, ""), (4, " \n"), (1, "ab"), (None, "zé")]
    out = token_counts.token_counts(documents(spark, rows), scores, limit=2, rows=2).collect()
    count = lambda t: sum(-best("▁" + w)[1] for w in (t or "").split())
    assert [(r.doc_id, r.n_pretokens, r.n_tokens) for r in out] == [(i, len((t or "").split()), count(t)) for i, t in rows]
    assert token_counts.token_counts(documents(spark, []), scores).collect() == []


def test_trie_scores_match_a_unigram_model(spark):
    """The library's own unigram model over the same pieces and scores finds no better segmentation."""
    from tokenizers import models

    scores = token_counts.ranked_scores(public_tokenizers.path("piece_bpe_32k.model"))
    model = models.Unigram([(p, s / 1e6) for p, s in scores.items()], 0, False)
    row = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()
    words = {"▁" + w for r in row for w in r.text.split()}
    words = {w for w in words if all(c in scores for c in w)}
    got = token_counts.TrieCounter(scores).counts(words)
    total = lambda parts: sum(scores[p] for p in parts)
    off = 0
    for w in words:
        parts = [t.value for t in model.tokenize(w)]
        off += len(parts) != got[w] and total(parts) != 0
        assert abs(len(parts) - got[w]) <= 1
    assert off <= len(words) * 0.01  # ties in the library's float sums


def least_distance(item, text):
    """Edit distance of the item to the nearest substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_matches_match_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    items = [" ".join(word() for _ in range(rng.randint(6, 14))) for _ in range(6)]
    docs = []
    for i in range(60):
        body = [word() for _ in range(rng.randint(0, 40))]
        if i % 2:
            passage = list(items[i % 6])
            for _ in range(rng.randint(0, 8)):
                at = rng.randrange(len(passage))
                passage[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "ab"])
            body.insert(rng.randint(0, len(body)), "".join(passage).upper())
        docs.append((i, "  ".join(body)))
    docs += [(60, None), (61, ""), (1, docs[1][1]), (None, items[0]), (70, "Z " * 20000 + items[2] + " z" * 20000)]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(50, None), (51, " -- ")], "item_id long, text string")
    rate = 0.15
    for chars in (10**6, 60):
        out = decontaminate.edit_matches(documents(spark, docs), bench, rate=rate, chars=chars).collect()
        got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.distance) for r in out)
        want = []
        for i, t in docs:
            for k, item in enumerate(items):
                f = decontaminate.folded(item)
                d = least_distance(f, decontaminate.folded(t or "")) if i != 70 else (0 if k == 2 else 99)
                if d <= decontaminate.budget(len(f), rate):
                    want.append((i if i is not None else -1, k, d))
        assert got == sorted(want)
        for r in out:
            assert least_distance(decontaminate.folded(items[r.item_id]), r.passage) == r.distance
        kept = decontaminate.clean(documents(spark, docs), bench, rate=rate, chars=chars)
        held = {w[0] for w in want}
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i is not None and i not in held)
        assert kept.columns == documents(spark, []).columns
    nothing = bench.limit(0)
    assert decontaminate.edit_matches(documents(spark, docs), nothing).collect() == []
    assert decontaminate.clean(documents(spark, docs), nothing).count() == len(docs)
    assert decontaminate.clean(documents(spark, []), bench).count() == 0
