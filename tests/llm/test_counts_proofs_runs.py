"""Token counts, Merkle proofs and periodic runs against plain versions of themselves, on rows
made to be awkward: nulls, empty and very long texts, ties, repeated rows, no rows, clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from countyrisk.llm import merkle, periodic_runs, queries, token_counts
from countyrisk.session import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("digest", "content", "version", "row", "tree", "place", "total", "node", "slot_0", "way", "deal", "runs", "words", "best")
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = lambda n: " ".join(rng.choice("Alpha béta gamma 12 x it's 日本".split()) + rng.choice(["", "s", str(rng.randint(0, 99))]) for _ in range(n))
    texts = [None, "", " \n\t ", "one", "one", "a <|endoftext|>b", "x\xa0  y \x1cz", words(20_000), "z" * 100_000, "ha " * 5_000, "Ab cd " * 9 + "Ab", words(300)]
    texts += [words(rng.randint(1, 60)) for _ in range(80)]
    made = [(k, t, (None, "en", "de", "日", "fr")[k * k % 5] if k % 7 else "lone" if k == 7 else "en", None if k % 4 == 0 else "hot", k if k % 3 else None) for k, t in enumerate(texts)]
    return made + made[3:6] + [(5, "another text", "en", "x", 1), (None, "Nobody", "en", None, None), (None, "Nobody", "en", None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, DOCS)
    for name in CLASHING:
        frame = frame.withColumn(name, frame.lang)
    return frame


def in_order(found):
    return sorted((tuple(r) for r in found), key=lambda r: tuple((v is not None, v) for v in r))


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# 11
def test_token_counts_and_cache(spark, docs, rows):
    library = tokenizers.Tokenizer.from_file(BPE)
    want = in_order((r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "", add_special_tokens=False).ids), n > 50) for r in rows)
    cache = scratch_dir(spark, "test-cache")
    assert in_order(token_counts.count_tokens(docs.where("doc_id % 2 = 0"), BPE, cache, 50).collect()) == [r for r in want if r[0] is not None and r[0] % 2 == 0]
    first = spark.read.parquet(cache)
    assert first.count() == len({r[1] or "" for r in rows if r[0] is not None and r[0] % 2 == 0})
    assert in_order(token_counts.count_tokens(docs, BPE, cache, 50).collect()) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.dropDuplicates(["digest"]).count() == len({r[1] or "" for r in rows})
    # nothing is encoded that is stored: a count changed there comes back
    changed = scratch_dir(spark, "test-cache")
    stored.selectExpr("digest", "n_tokens + 1000 AS n_tokens", "version").write.mode("append").partitionBy("version").parquet(changed)
    assert in_order(token_counts.count_tokens(docs, BPE, changed, 50).collect()) == in_order((a, b, c + 1000, True) for a, b, c, _ in want)
    # appended twice by two runs at once
    stored.write.mode("append").partitionBy("version").parquet(cache)
    assert in_order(token_counts.count_tokens(docs, BPE, cache, 50).collect()) == want
    assert token_counts.count_tokens(docs.where("false"), BPE).count() == 0


def test_other_tokenizers_have_counts_of_their_own(spark, docs, rows):
    import sentencepiece

    cache = scratch_dir(spark, "test-cache")
    some = docs.where("doc_id between 3 and 40")
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        file = public_tokenizers.path(name)
        if name.endswith(".model"):
            model = sentencepiece.SentencePieceProcessor(model_file=file)
            count = lambda t, model=model: len(model.encode(t))
        else:
            library = tokenizers.Tokenizer.from_file(file)
            count = lambda t, library=library: len(library.encode(t, add_special_tokens=False).ids)
        found = {(r.doc_id, r.n_bytes): r.n_tokens for r in token_counts.count_tokens(some, file, cache).collect()}
        assert found == {(r[0], len((r[1] or "").encode())): count(r[1] or "") for r in rows if r[0] is not None and 3 <= r[0] <= 40}
    assert spark.read.parquet(cache).select("version").distinct().count() == 2


def test_pieces_count_like_whole_texts():
    library = tokenizers.Tokenizer.from_file(BPE)
    own = token_counts.Tokenizer(BPE)
    rng = random.Random(1)
    signs = [*"ab!1'’ \n\t\r\x0b\x0c\x1c\x1f\x85\xa0​ ᠎ 　é日", "<|endoftext|>", "'re"]
    odd = ["".join(rng.choices(signs, k=rng.randint(1, 25))) for _ in range(20_000)]
    odd += [f"{s}{chr(c)}  {chr(c)}x" for s in "a! " for c in (*range(0xD800), *range(0xE000, 0x3100))]
    want = [len(e.ids) for e in library.encode_batch(odd, add_special_tokens=False)]
    assert token_counts.counter(own.library, own.blob)(odd) == want
    assert not token_counts.cuts_at_spaces({"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}})
    assert not token_counts.cuts_at_spaces({"pre_tokenizer": {"type": "ByteLevel"}, "normalizer": {"type": "NFC"}})


# 12
def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return sha(part(row[0]), part(row[3]), part(row[2]), part(row[4]), part(text))


def climb(digests):
    ways, own = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for way, k in zip(ways, own, strict=True):
            way.append(("".join(digests[k // 8 * 8 : k]), "".join(digests[k + 1 : k // 8 * 8 + 8])))
        own = [k // 8 for k in own]
        digests = [sha(*digests[k : k + 8]) for k in range(0, len(digests), 8)]
    return digests[0], ways


def manifest(rows):
    trees = []
    for lang in sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode())):
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r, r[1]), r) for r in rows if r[2] == lang), key=lambda o: o[:3])
        trees.append((own, *climb([o[2] for o in own])))
    root, tops = climb([subroot for _, subroot, _ in trees])
    for (own, subroot, ways), top in zip(trees, tops, strict=True):
        for (_, _, digest, row), way in zip(own, ways, strict=True):
            forged = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None
            folded = leaf(row, re.sub("[A-Z]", lambda m: m[0].lower(), row[1])) if forged else digest
            for before, after in way + top:
                folded = sha(before, folded, after)
            yield row[0], digest, subroot, root, sha(*[a + b for a, b in way + top]), folded, folded == root


def test_merkle_manifest(docs, rows):
    found = in_order(merkle.merkle_manifest(docs).collect())
    assert found == in_order(manifest(rows)) and {r[-1] for r in found} == {True, False}
    assert in_order(merkle.merkle_manifest(docs.where("doc_id = 7")).collect()) == in_order(manifest([r for r in rows if r[0] == 7]))
    assert merkle.merkle_manifest(docs.where("false")).count() == 0


def test_ranges_are_even_without_ids(spark):
    same = spark.range(100_000).selectExpr("'' AS tree", "CAST(NULL AS bigint) AS doc_id", "'x' AS leaf")
    placed = merkle.numbered(same, ["doc_id", "leaf"], "test-numbers")
    spread = merkle.written(placed, "test-places")
    assert spread.selectExpr("count(distinct place) = 100000 AND min(place) = 0 AND max(place) = 99999 AND min(total) = 100000").first()[0]
    dealt = same.withColumn("deal", merkle.F.rand(12)).repartitionByRange(8, "tree", "doc_id", "leaf", "deal")
    assert max(r[1] for r in dealt.groupBy(merkle.F.spark_partition_id()).count().collect()) < 25_000


# 13
def plain_runs(words):
    ids, found = {}, {}
    numbers = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    for q in range(1, len(words) // 4 + 1):
        turns = np.diff(np.concatenate([[0], (numbers[:-q] == numbers[q:]).astype(np.int8), [0]]))
        for start, end in zip(np.flatnonzero(turns == 1), np.flatnonzero(turns == -1), strict=True):
            if end - start + q >= max(6, 4 * q):
                found.setdefault((int(start), int(end - start + q)), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def runs(texts, rng):
    names = {}
    words = np.array([names.setdefault(w, rng.getrandbits(64)) for t in texts for w in t], np.uint64)
    sizes = [len(t) for t in texts]
    found = periodic_runs.runs_of(words, np.repeat(np.arange(len(texts)), sizes), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), 4, 6)
    return [[tuple(r[1:].tolist()) for r in found if r[0] == k] for k in range(len(texts))]


def test_runs_of_many_random_texts():
    rng = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(6):
            text, size = [], rng.randint(0, 150)
            while len(text) < size:
                block = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 12))]
                text += (block * rng.randint(1, 9))[: rng.randint(1, 60)]
            texts.append(text)
        assert runs(texts, rng) == [plain_runs(t) for t in texts]


def test_runs_of_long_texts():
    one, two = ["a"], ["b"]
    for _ in range(17):
        one, two = one + two, one
    parity = [str(bin(k).count("1") % 2) for k in range(5_000)]
    texts = [list("a" * 5_000), list("ab" * 3_000 + "c"), [], one[:6_000], parity, [str(k % 701) for k in range(9_000)]]
    assert runs(texts, random.Random(2)) == [plain_runs(t) for t in texts]


def test_run_report(docs, rows):
    def report(row):
        words, h = WORD.findall(row[1] or ""), zlib.crc32(str(row[0]).encode()) if row[0] is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            words = [words[i] if i < a else words[a + (i - a) % (1 + (n - a) // (3 + g % 8))] for i in range(n)]
        found, dropped = plain_runs(words), set()
        for start, length, period in found:
            dropped |= set(range(start + period, start + length))
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        return (row[0], len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), sha(kept))

    found = in_order(periodic_runs.run_report(docs, planted=True).collect())
    assert found == in_order(report(r) for r in rows)
    assert sum(r[1] > 0 for r in found) > 3 and max(r[3] or 0 for r in found) >= 5_000
    assert periodic_runs.run_report(docs.where("false"), planted=True).count() == 0
    plain = periodic_runs.find_runs(docs.where("doc_id = 10")).first()
    assert plain.collapsed == "Ab cd" and plain.runs == [(0, 19, 2)] and plain.n_words == 19
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, repeats=3)


def test_registered_queries_read_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect())
    for name in ("op11_token_counts", "op12_merkle", "op13_periodic_runs"):
        assert sorted(r.doc_id for r in queries.QUERIES[name](spark, sf).select("doc_id").collect()) == ids
