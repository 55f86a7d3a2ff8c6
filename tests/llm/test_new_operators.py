"""Archives, token alignment and collocations against brute force, and their edge cases."""

import base64
import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bioobs.llm import collocations, token_alignment, warc

FOLDER = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


# operator 11

LONG_PAGE = "<p>" + "".join(f"para {i % 977} é " for i in range(200_000)) + "</p>"
PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, "http://a/3\r\nX: y", None),
    (4, None, ""),
    (None, "http://a/5", "<p>one</p>"),
    (None, None, "only here\r\n\r\nWARC/1.1"),
    (7, "http://ä/7", LONG_PAGE),
    (6, "http://a/6", LONG_PAGE),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return rows.withColumns({c: F.lit(c) for c in ("row", "digest", "first", "payload", "size", "record_id", "times")})


def archived_by_hand(rows):
    """Counter of the rows that archived_pages must give."""
    by_payload = defaultdict(list)
    for page_id, _, html in rows:
        by_payload[(html or "").encode()].append(page_id)
    out = Counter()
    for payload, ids in by_payload.items():
        ids.sort(key=lambda i: (i is None, -(i or 0)))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, i in enumerate(ids):
            out[i, len(payload), digest, "revisit" if k else "response", ids[0] if k else None] += 1
    return out


def test_archives_by_hand(pages):
    assert Counter(map(tuple, warc.archived_pages(pages).collect())) == archived_by_hand(PAGES)
    assert warc.archived_pages(pages.limit(0)).collect() == []


def test_archive_files_and_payloads(spark, tmp_path):
    """Each archive begins with its dictionary, every record is a frame of its own, and payloads come back whole."""
    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").coalesce(2)
    warc.write_archives(rows, str(tmp_path / "a"), collection="c")
    files = [f for f in (tmp_path / "a").glob("part-*") if f.stat().st_size]
    assert files
    for f in files:
        data = f.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_MAGIC
        learned = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        assert learned.dict_id()
        first = data[8 + size + len(warc.EMPTY_FRAME) :]
        assert zstandard.get_frame_parameters(first).dict_id == learned.dict_id()
        with pytest.raises(zstandard.ZstdError):  # not readable without the dictionary
            zstandard.ZstdDecompressor().decompress(first)
    found = warc.read_archives(spark, str(tmp_path / "a"))
    got = {r.page_id: bytes(r.payload).decode() for r in found.where("record_type = 'response'").collect()}
    assert got == {r.page_id: r.html for r in rows.collect()}
    assert found.select("record_id").distinct().count() == found.count() == rows.count()


def test_dictionary_pays():
    records = [f"header {i} the same words in every record, {i * 7919 % 1000}".encode() * 3 for i in range(500)]
    learned = zstandard.ZstdCompressionDict(warc.build_dictionary(records))
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert sum(len(zstandard.ZstdCompressor(level=3, dict_data=learned).compress(r)) for r in records) < plain / 2
    assert warc.build_dictionary([]) is None and warc.build_dictionary([b"x"]) is None


def test_broken_archives_are_refused():
    record = warc.record("c", "d", 1, 1, "u", b"payload", 7, "00" * 20, None, None)
    frame = zstandard.ZstdCompressor().compress(record)
    assert list(warc.records_of(frame)) == [record]
    with pytest.raises(ValueError):
        list(warc.records_of(frame[:-3]))
    with pytest.raises(ValueError):
        warc.parse_record(record[:-2])


# operator 12

TEXTS = [
    (1, "one two  three\n\nfour"),
    (1, "one two  three\n\nfour"),
    (None, "Größe 北京 \U0001f600 é"),
    (3, None),
    (4, ""),
    (5, "a ▁ piece space"),
    (6, "<|endoftext|> <s> <0x41> A"),
    (7, " " * 50 + "x" * 5000 + "\t\r\n"),
    (8, "ﬁ ligature   and 　 spaces \x00 \x1c"),
    (9, "words and more words " * 20_000),
]


@pytest.fixture(scope="module")
def reference_tokenizers():
    import sentencepiece

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def aligned_by_hand(rows, a, b):
    """Rows of aligned_documents, from the libraries' own tokens and plain loops."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in printed]
    alphabet = {chr(x): x for x in printed} | {chr(256 + i): x for i, x in enumerate(hidden)}
    spell_a = lambda i: bytes(alphabet[c] for c in a.id_to_token(i))
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for _, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        said = (" " + (text or "")).encode()
        if b"".join(map(spell_a, ids_a)) != said or b"".join(map(spell_b, ids_b)) != said:
            ids_a = ids_b = []
        links, groups, i, j, end_a, end_b = [], [([], [])], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):  # walk both lists by their ends
            if end_a == end_b:
                if groups[-1][0]:
                    groups.append(([], []))
                groups[-1][0].append(ids_a[i]), groups[-1][1].append(ids_b[j])
                end_a, end_b, i, j = end_a + len(spell_a(ids_a[i])), end_b + len(spell_b(ids_b[j])), i + 1, j + 1
            elif end_a < end_b:
                groups[-1][0].append(ids_a[i])
                end_a, i = end_a + len(spell_a(ids_a[i])), i + 1
            else:
                groups[-1][1].append(ids_b[j])
                end_b, j = end_b + len(spell_b(ids_b[j])), j + 1
            links.append((ids_a[i - 1], ids_b[j - 1]))
        groups = [g for g in groups if g[0]]
        digest = hashlib.sha256(";".join("|".join(",".join(map(str, side)) for side in g) for g in groups).encode()).hexdigest() if groups else ""
        found.append((len(ids_a), len(ids_b), len(groups), links, digest))
        counts.update(links)
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return Counter(
        (i, n_a, n_b, n_g, len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), digest)
        for (i, _), (n_a, n_b, n_g, links, digest) in zip(rows, found)
    )


def test_alignment_edges(spark, reference_tokenizers):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(c) for c in ("row", "pair", "n", "best", "pairs", "times")})
    got = token_alignment.aligned_documents(docs, *PATHS)
    assert Counter(map(tuple, got.collect())) == aligned_by_hand(TEXTS, *reference_tokenizers)
    assert token_alignment.aligned_documents(docs.limit(0), *PATHS).collect() == []


def test_alignment_of_the_corpus(spark, reference_tokenizers):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert Counter(map(tuple, token_alignment.aligned_documents(docs, *PATHS).collect())) == aligned_by_hand(rows, *reference_tokenizers)


def test_alignment_joins_pairs_by_shuffle_alike(spark, reference_tokenizers, monkeypatch):
    rows = TEXTS[:6] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(token_alignment, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(token_alignment, "GATHERED", 3)
    assert Counter(map(tuple, token_alignment.aligned_documents(docs, *PATHS).collect())) == aligned_by_hand(rows, *reference_tokenizers)


def test_ranks_say_the_same_for_every_character(reference_tokenizers):
    """Encoding by ranks equals the tokenizer's own file around every code point of the first three planes."""
    quick, own = token_alignment.same_by_ranks(PATHS[0]), reference_tokenizers[0]
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{chr(c)}b 1{chr(c)}2 .{chr(c)}. {chr(c)}x  {chr(c)}y {chr(c)}{chr(c)}  {chr(c)} '{chr(c)}'s{chr(c)}\n{chr(c)}\t {chr(c)}" for c in points]
    for at in range(0, len(texts), 8192):
        part = texts[at : at + 8192]
        for t, e in zip(part, own.encode_batch(part, add_special_tokens=False)):
            assert quick.encode_ordinary(t) == e.ids


# operator 13


def collocations_by_hand(rows, least, most):
    grams, total, spelled = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in range(1, 6):
                grams[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    for lang, f in grams.items():
        often = {p: n for p, n in f.items() if n >= least and len(p) > 1}
        inside = defaultdict(int)
        for p, n in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], n)
        kept = []
        for p, a in often.items():
            if 100 * inside[p] >= 100 * a:
                continue
            cuts = [(1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            spelled.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(spelled)


def random_rows(seed, n):
    dice = random.Random(seed)
    words = ["a", "B", "the", "né", "x1", " ", "of", "in-deed", "\x00", "z"]
    text = lambda: "".join(dice.choice(words) + dice.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(dice.randrange(40)))
    rows = [(dice.choice(["en", "en", "de", None, "und", ""]), text()) for _ in range(n)]
    return rows + [("en", None), (None, None), ("en", ""), ("fr", ".,;"), ("es", "very " * 3000), ("en", "the of in-deed a b " * 400)]


@pytest.mark.parametrize("shard_words, range_words, small", [(1 << 21, 1 << 20, True), (60, 50, True), (700, 300, False)])
def test_collocations_by_hand(spark, monkeypatch, shard_words, range_words, small):
    """Shards and ranges of any size, and joins by shuffle, give the same phrases."""
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(collocations, "RANGE_WORDS", range_words)
    if not small:
        monkeypatch.setattr(collocations, "broadcast_if_small", lambda df: df)
    rows = random_rows(shard_words, 400)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    docs = docs.withColumns({c: F.lit(c) for c in ("ids", "shard", "word", "f", "rank", "n", "range")})
    got = sorted(map(tuple, collocations.collocations(docs, least=6, most=50).collect()))
    assert got == collocations_by_hand(rows, 6, 50)


def test_collocations_without_phrases(spark):
    docs = spark.createDataFrame([("en", "a b"), (None, None)], "lang string, text string")
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    """The product of 1000, a and n passes 2^64 and stays exact."""
    big = 3_000_000_019
    words = spark.createDataFrame([(1, "en", "x", 7 * big), (2, "en", "y", 7 * big)], "word long, lang string, spelled string, n long")
    phrases = spark.createDataFrame([([1], big), ([2], big + 2), ([1, 2], big - 5)], "ids array<bigint>, f long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda docs, least: (phrases, words))
    row = collocations.collocations(phrases).first()
    assert 1000 * (big - 5) * 7 * big > 2**64
    assert (row.phrase, row.score) == ("x y", 1000 * (big - 5) * 7 * big // (big * (big + 2)))


def test_index_counts_every_phrase():
    """Extension to both sides finds all phrases of a random text up to the depth, with their counts."""
    text = np.concatenate([[0], np.random.default_rng(5).integers(0, 5, 3000), [0]])
    forward, backward = collocations.Index(collocations.Index.transform(text)), collocations.Index(collocations.Index.transform(text[::-1]))
    known = collocations.words_of(forward)
    words = forward.first[known.low][:, None]
    for length in range(2, collocations.LONGEST + 1):
        known, head, tail = collocations.longer(forward, backward, known)
        words = np.hstack([words[head], words[tail][:, -1:]])
        want = Counter(tuple(text[i : i + length].tolist()) for i in range(len(text) - length + 1) if (text[i : i + length] > 0).all())
        assert dict(zip(map(tuple, words.tolist()), known.size.tolist())) == want
