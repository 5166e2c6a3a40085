"""Quality rules, BPE, language identification, n-gram model and classifier: brute force, round trips, held-out accuracy, edge rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from sharelens.llm import bpe, language_id, ngram_lm, quality_classifier, quality_rules, queries
from sharelens.llm import textarrays as T

from .conftest import MESSY, PROSE, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(spark, sf=SF_SMALL):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def _crc(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


# ---- quality rules ---------------------------------------------------------

def _base(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {p for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": dup, "n_repeat_words": len(hit), "base_failed": n < 20 or 100 * len(hit) > 30 * n}


def test_quality_rules_against_brute_force(spark):
    docs = _docs(spark)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and not r["toxic"]}

    def grams(text):
        words = WORD.findall(text or "")
        return [(w,) for w in words] + list(zip(words, words[1:], strict=False))

    def bucket(gram):
        buf, offsets = T.encode([" ".join(gram)])
        s, e, t = T.words(buf, offsets)
        h = T.span_hashes(buf, s, e)
        return int((h[0] if len(gram) == 1 else T.windows(h, t, 2)[0][0]) % T.U64(quality_rules.BUCKETS))

    buckets = {i: [bucket(g) for g in grams(r["text"])] for i, r in docs.items()}
    raw = Counter(b for x in buckets.values() for b in x)
    target = Counter(b for i, x in buckets.items() if i in good for b in x)
    size, n_raw, n_target = quality_rules.BUCKETS, sum(raw.values()), sum(target.values())
    folds = {r["i"]: r["f"] for r in spark.createDataFrame([(i,) for i in good], "i long").selectExpr(
        "i", f"pmod(xxhash64('fold', i), {quality_rules.FOLDS}) as f").collect()}
    crossed = []                     # trusted documents scored without their own fold in the target
    for i in good & docs.keys():
        if _base(docs[i]["text"])["base_failed"]:
            continue
        rest = Counter(b for x in good & docs.keys() if folds[x] != folds[i] for b in buckets[x])
        n_rest = sum(rest.values())
        crossed.append(sum(math.log((rest[b] + 1) / (n_rest + size)) - math.log((raw[b] + 1) / (n_raw + size)) for b in buckets[i]) / len(buckets[i]))
    threshold = float(np.quantile(crossed, quality_rules.CLEAN_LOSS))
    assert quality_rules.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.createDataFrame([(i,) for i in good], "i long"))[1] == \
        pytest.approx(threshold, abs=1e-9)
    got = queries.QUERIES["op7_quality_rules"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        want = _base(docs[r["doc_id"]]["text"])
        assert {k: r[k] for k in want} == want
        logs = [math.log((target[b] + 1) / (n_target + size)) - math.log((raw[b] + 1) / (n_raw + size)) for b in buckets[r["doc_id"]]]
        score = sum(logs) / max(len(logs), 1)
        assert r["score"] == pytest.approx(score, abs=1e-9)
        if abs(score - threshold) > 1e-9:
            assert r["kept"] == (not want["base_failed"] and score >= threshold)


def test_quality_rules_edge_rows(spark, messy, nothing):
    ids = spark.createDataFrame([(1,), (None,)], "doc_id long")
    none = ids.limit(0)
    got = quality_rules.judge(messy, quality_rules.log_ratio(messy, ids)).collect()
    assert len(got) == len(MESSY)
    for r in got:
        want = _base(r["row"]["text"])
        assert {k: r["q"][k] for k in want} == want
    assert (quality_rules.log_ratio(messy, none) == 0).all()
    kept = quality_rules.keep_documents(messy, none)
    assert kept.columns == messy.columns and {r["doc_id"] for r in kept.collect()} >= {1, 2}
    assert quality_rules.keep_documents(nothing, ids).collect() == []


def test_quality_rules_use_every_trusted_document(spark):
    docs = spark.range(20_400).selectExpr("id as doc_id", "concat('word', id) as text")
    ids = docs.select("doc_id")
    assert (quality_rules.log_ratio(docs, ids) == 0).all()            # the target is the corpus


def test_quality_fit_is_the_same_when_the_ids_are_joined(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ids = quality_rules.trusted_labels(spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    ratio, threshold = quality_rules.fit(docs.unionByName(docs), ids.union(ids))
    monkeypatch.setattr(quality_rules, "BROADCAST_IDS", 0)
    joined = quality_rules.fit(docs.unionByName(docs), ids)
    assert (joined[0] == ratio).all() and joined[1] == pytest.approx(threshold, abs=1e-12)


def test_quality_threshold_is_calibrated_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.QUERIES["op7_quality_rules"](spark, sf).join(labels, "doc_id").where("n_words >= 20").collect()
    lost = lambda some: sum(not r["kept"] for r in some) / len(some)
    clean = [r for r in rows if r["quality"] == 1 and not r["toxic"] and not r["base_failed"]]
    toxic, bad = [r for r in rows if r["toxic"]], [r for r in rows if r["quality"] == 0 and not r["toxic"]]
    print("lost: clean", lost(clean), "toxic", lost(toxic), "bad", lost(bad), "threshold", min(r["score"] for r in rows if r["kept"]))
    assert lost(clean) <= quality_rules.CLEAN_LOSS
    assert lost(toxic) > 3 * quality_rules.CLEAN_LOSS and lost(bad) > 0.95


# ---- BPE -------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference():
    tok = Tokenizer.from_file(bpe.default_vocabulary())
    tok.no_truncation()
    tok.no_padding()
    return tok


def _digests(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    decoded = tok.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_bpe_equals_the_library(spark, reference):
    docs = _docs(spark)
    got = queries.QUERIES["op3_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == _digests(reference, docs[r["doc_id"]]["text"]) for r in got)


def test_bpe_edge_rows(spark, messy, nothing, reference):
    got = bpe.encode_decode(messy).collect()
    assert sorted(str(r["row"]["doc_id"]) for r in got) == sorted(str(x[0]) for x in MESSY)
    for r in got:
        ids = reference.encode(r["row"]["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["bpe"]["ids"], "<u4").tolist() == ids and r["bpe"]["n_tokens"] == len(ids)
        assert r["bpe"]["decoded"] == reference.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(nothing).collect() == []


@pytest.mark.parametrize("mean", [8, 64, 1024])
def test_bpe_joins_are_exact(reference, mean):
    rng = np.random.default_rng(mean)
    codec = bpe.Codec(bpe.default_vocabulary())
    texts = ["".join(rng.choice(list("ab c'sé\n\t1.!<|>日  "), 1500)) for _ in range(30)]
    texts += ["ab <|endoftext|> cd<|endoftext|>" * 60, "a" * 3000, " " * 3000, "it's we'll 12 345\n\n x" * 100, PROSE * 5]
    for text in texts:
        buf, offsets = T.encode([text])
        ids = codec.encode(buf.tobytes(), bpe.chunk_cuts(buf, offsets, mean)[0])
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids


def test_bpe_encodes_a_shared_chunk_once():
    codec = bpe.Codec(bpe.default_vocabulary())
    text = " ".join(f"{w} {i}" for i, w in enumerate(PROSE.split() * 20))
    work = []
    for t in (text, text, "another start, then " + text):
        before = codec.encoded_bytes
        buf, offsets = T.encode([t])
        codec.encode(buf.tobytes(), bpe.chunk_cuts(buf, offsets)[0])
        work.append(codec.encoded_bytes - before)
    assert work[1] == 0 and work[2] < work[0] / 2


def test_bpe_tasks_of_a_worker_share_the_vocabulary(spark, monkeypatch):
    made, real = [], bpe.text_udf
    monkeypatch.setattr(bpe, "text_udf", lambda fn, schema, make=None: made.append(make) or real(fn, schema, make))
    bpe.encode_decode(spark.createDataFrame([(1, PROSE)], "doc_id long, text string"))
    make = made[-1]
    assert make() is make()


def test_bpe_of_many_small_tasks_equals_the_library(spark, reference):
    rows = [(i, f"{PROSE} {i} " * (i % 7)) for i in range(300)] + [(300, None), (301, PROSE), (301, PROSE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        got = bpe.encode_decode(docs).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(r["row"]["doc_id"] for r in got) == sorted(i for i, _ in rows)
    for r in got:
        ids = reference.encode(r["row"]["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["bpe"]["ids"], "<u4").tolist() == ids
        assert r["bpe"]["decoded"] == (r["row"]["text"] or "")


# ---- language --------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = _docs(spark, sf)
    got = queries.QUERIES["op5_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (_crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) / len(held) > 0.93
    sure = [r for r in held if not r["rejected"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in sure) / len(sure) > 0.97


def test_language_edge_rows(spark, messy, nothing):
    learned = language_id.learn(messy)
    assert set(learned) == {"en", "fr"} and all(len(x) <= language_id.DICT_BYTES for x in learned.values())
    got = language_id.predict(messy, learned).collect()
    assert len(got) == len(MESSY)
    for r in got:
        if not re.search(r"[^\W\d_]", r["row"]["text"] or ""):
            assert (r["lid"]["lang"], r["lid"]["score"]) == ("und", 0.0)
        else:
            assert r["lid"]["lang"] in learned
    assert language_id.learn(nothing) == {} and language_id.predict(nothing, {}).collect() == []
    assert {r["lid"]["lang"] for r in language_id.predict(messy, {}).collect()} == {"und"}
    assert {r["lid"]["score"] for r in language_id.predict(messy.where("doc_id = 1"), {"en": b"abc"}).collect()} == {1.0}


# ---- n-gram model ----------------------------------------------------------

def _lm_tokens(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*WORD.findall(low), None]


def _kneser_ney(texts):
    pair, heads = Counter(), defaultdict(set)
    for t in texts:
        last = "<s>"
        for w in _lm_tokens(t):
            pair[last, w] += 1
            heads[w].add(last)
            last = w
    cont = {w: len(h) for w, h in heads.items()}
    few = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    d2, d1 = ngram_lm.discounts(few(pair.values())), ngram_lm.discounts(few(cont.values()))
    total = sum(cont.values())
    floor = (sum(d1[min(c, 3)] for c in cont.values()) / total if total else 1.0) / (len(cont) + 1)
    context = defaultdict(list)
    for (v, _), c in pair.items():
        context[v].append(c)

    def score(text):
        out, last = 0.0, "<s>"
        for w in _lm_tokens(text):
            c = cont.get(w, 0)
            p = floor + ((c - d1[min(c, 3)]) / total if c else 0)
            if own := context.get(last):
                k = pair.get((last, w), 0)
                p = max(k - d2[min(k, 3)], 0) / sum(own) + sum(d2[min(x, 3)] for x in own) / sum(own) * p
            out += math.log10(p)
            last = w
        return out

    return score


def _lm_check(rows, train, docs_text):
    counts = Counter(w for t in train for w in _lm_tokens(t))
    n, v = sum(counts.values()), len(counts)
    score = _kneser_ney(train)
    for text, r in zip(docs_text, rows, strict=True):
        tokens = _lm_tokens(text)
        assert r["n_tokens"] == len(tokens) and r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9, abs=1e-9)
        assert r["score"] == pytest.approx(score(text), rel=1e-9, abs=1e-9)


def test_ngram_model_against_brute_force(spark):
    docs = _docs(spark)
    train = [r["text"] for i, r in docs.items() if _crc(i, 7) != 2]
    got = queries.QUERIES["op6_ngram_lm"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (_crc(r["doc_id"], 7) == 2) for r in got)
    assert {r["train_tokens"] for r in got} == {sum(len(_lm_tokens(t)) for t in train)}
    _lm_check(got, train, [docs[r["doc_id"]]["text"] for r in got])
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_ngram_model_edge_rows(spark, messy, nothing):
    model = ngram_lm.train(messy)
    got = ngram_lm.score(messy, model).collect()
    assert len(got) == len(MESSY)
    _lm_check([r["lm"] for r in got], [x[1] for x in MESSY], [r["row"]["text"] for r in got])
    untrained = ngram_lm.train(nothing)
    assert untrained["total"] == 0 and ngram_lm.score(nothing, untrained).collect() == []
    assert {(r["lm"]["base_score"], r["lm"]["score"], r["lm"]["n_known"]) for r in ngram_lm.score(messy, untrained).collect()} == {(0.0, 0.0, 0)}


def test_ngram_model_sums_to_one(spark):
    texts = ["a b a c", "a b", "b b b", "a"]
    model = ngram_lm.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    scorer = ngram_lm.Scorer(model)
    vocabulary = {}
    for t in texts:
        _, word, _ = ngram_lm.tokens([t])
        vocabulary.update(dict.fromkeys(word.tolist()))
    word = np.array([*vocabulary, 12345], np.uint64)   # and one unknown word
    _, p = scorer.words(word)
    assert p.sum() == pytest.approx(1)
    for t in texts:
        context, _, _ = ngram_lm.tokens([t])
        for c in context:
            assert scorer.pairs(np.full(len(word), c, np.uint64), word, p).sum() == pytest.approx(1)


# ---- classifier ------------------------------------------------------------

def test_classifier_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES["op4_quality_classifier"](spark, sf).collect()
    assert len(got) == len(_docs(spark, sf)) and all(0 <= r["score"] <= 1 for r in got)
    known = [(r["kept"], labels[r["doc_id"]]) for r in got if r["doc_id"] in labels]
    good, bad = [k for k, q in known if q == 1], [k for k, q in known if q == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.15


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.7
    rate = np.array([0.9, 0.8, 0.85, 0.7, 0.75, 0.8, 0.9, 0.6])
    right = rng.random((len(truth), 8)) < rate
    votes = np.where(right == truth[:, None], 1, -1)
    votes[rng.random(votes.shape) < 0.4] = 0
    pattern = quality_classifier.pattern_of(votes)
    assert (quality_classifier.votes_of(pattern) == votes).all()
    keys, counts = np.unique(pattern, return_counts=True)
    posterior = quality_classifier.fit_votes(keys, counts)
    guess = posterior[pattern] >= 0.5
    majority = votes.sum(axis=1) >= 0
    assert (guess == truth).mean() > max(0.9, (majority == truth).mean())


def test_classifier_edge_rows(messy, nothing):
    got = quality_classifier.score(messy, *quality_classifier.learn(messy)).collect()
    assert len(got) == len(MESSY)
    by_text = defaultdict(set)
    for r in got:
        by_text[(r["row"]["text"] or "").strip()].add(r["c"]["score"])
    assert all(len(x) == 1 for x in by_text.values())
    assert quality_classifier.score(nothing, *quality_classifier.learn(nothing)).collect() == []


# ---- samples, counts and shards -------------------------------------------------

def test_classifier_sample_takes_each_text_once(spark, monkeypatch):
    """A third of all rows is one text: the sample holds it once, and never more rows than its bound."""
    seen = []
    fit = quality_classifier.fit_scorer
    monkeypatch.setattr(quality_classifier, "fit_scorer", lambda b, v, o, t, **k: seen.append(len(t)) or fit(b, v, o, t, **k))
    rows = [(i, f"text number {i} with some words {i % 7}") for i in range(400)] + [(1000 + i, PROSE) for i in range(200)] + [(None, None)] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    quality_classifier.learn(df, sample_docs=10_000)
    quality_classifier.learn(df, sample_docs=20)
    assert seen[0] == 402 and seen[1] <= 40


def test_language_sample_ranks_texts_not_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 30)
    texts = [f"unique text number {i} in english words" for i in range(100)]
    rows = [(t, "en") for t in texts] + [("the same copy of a text", "en")] * 400 + [("un texte", "fr"), (None, "de"), ("x", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = language_id.learn(df)
    assert sorted(got) == ["en", "fr"]
    assert len(got["en"].decode().split("\n")) == 30
    monkeypatch.setattr(language_id, "MAX_LANGS", 1)
    assert sorted(language_id.learn(df)) == ["en"]


def test_language_id_against_compressing_in_a_loop(spark):
    import zstandard

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    dictionaries = language_id.learn(docs)
    got = {r["row"]["doc_id"]: r["lid"] for r in language_id.predict(docs, dictionaries).collect()}
    some = [r for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"])][:60]
    for r in some:
        sizes = {}
        for lang, d in dictionaries.items():
            params = zstandard.ZstdCompressionParameters.from_level(
                language_id.LEVEL, source_size=language_id.PIECE, dict_size=len(d), write_content_size=False, write_dict_id=False,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=params)
            data = r["text"].lower().encode()
            sizes[lang] = sum(len(c.compress(data[i:i + language_id.PIECE])) for i in range(0, len(data), language_id.PIECE))
        assert got[r["doc_id"]]["lang"] == min(sizes, key=lambda x: (sizes[x], x))


def test_counts_beyond_32_bits():
    wide = np.array([1, 2 ** 32, 2 ** 40], np.int64)
    assert ngram_lm._narrow(wide).tolist() == wide.tolist()
    assert ngram_lm._narrow(np.array([1, 2 ** 32 - 1], np.int64)).dtype == np.uint32
    keys, counts = ngram_lm._sums(np.array([5, 5, 5], np.uint64), np.array([2 ** 32 - 1] * 3, np.uint32).astype(np.int64))
    assert ngram_lm._narrow(counts).tolist() == [3 * (2 ** 32 - 1)] and keys.tolist() == [5]


def test_a_task_gets_one_shard(spark):
    rows = spark.range(48 * 5).selectExpr("cast(id % 48 as int) as shard").repartitionById(48, "shard")
    got = [set(x) for x in rows.rdd.map(lambda r: r[0]).glom().collect() if x]
    assert len(got) == 48 and all(len(x) == 1 for x in got)
