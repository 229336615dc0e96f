import random
import re
import sys
import textwrap
import zlib
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import decontamination, language_id, license_scan, lm_score, near_dedup, quality_rules, secret_scan, suffix_dedup, textbuf, warc_bundles
from strandline.llm.components import components

sys.path.insert(0, str(Path(__file__).parent.parent))
DATA = "/root/testdata/sf0.001"
WORDS = "the of and to in it was for on as with by at from this that no or be an".split()


def texts(seed=0, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(WORDS) + rng.choice(["", "x", "yz", ","]) for _ in range(rng.randint(1, 160))) for _ in range(n)]
    for k in range(0, n, 3):  # near copies, long common passages and exact copies
        w = base[k].split()
        w[rng.randrange(len(w))] = "changed"
        base.append(" ".join(w))
        base.append(base[k] + "\n" + base[(k + 1) % n])
        base.append(base[k])
    base += [None, "", " ", "\n\n", "a", "a b c d", "É" * 60, "z" * 5000, "é中\U0001f600 " * 40]
    return base


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows, and columns whose names operators use inside."""
    rows = [(i, t, "en", "s", 1, "v") for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, values string").cache()


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_contamination(spark, docs):
    rows = pairs(docs)
    items = [(100 + k, " ".join((t or "").split()[3:20])) for k, (_, t) in enumerate(rows[::9])] + [(7, None), (8, ""), (9, "of"), (10, rows[0][1]), (11, rows[0][1])]
    got = decontamination.report(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(brute.contamination(rows, items))
    none = decontamination.report(docs, spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == len(rows) and not none.where("contaminated").count()
    assert decontamination.report(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clean_goes_by_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"x {passage} y"), (1, "clean text"), (None, passage), (None, None), (2, ""), (2, passage)]
    left = decontamination.clean(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(1, "clean text"), (None, None), (2, "")], key=str)


def test_queries_match_their_sql(spark):
    from oracle import assert_same

    from strandline.llm import queries

    for name, sql in queries.oracle_sql().items():
        assert_same(queries.queries()[name](spark, DATA), sql, DATA)
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith("suffix")]


def test_empty_tables(spark):
    from strandline.llm import queries, sentencepiece_codec

    docs, pages = spark.read.parquet(f"{DATA}/documents.parquet").limit(0), spark.read.parquet(f"{DATA}/pages.parquet").limit(0)
    labels, items = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("labels", "benchmark"))
    model = sentencepiece_codec.default_model()
    made = [quality_rules.report(docs, labels), quality_rules.kept(docs, labels.limit(0)), language_id.report(docs), license_scan.report(docs), secret_scan.redacted(docs), near_dedup.kept(docs), decontamination.clean(docs, items), suffix_dedup.report(docs), warc_bundles.report(pages), sentencepiece_codec.round_trip(docs, model)]
    assert [df.count() for df in made] == [0] * len(made)


def test_repeated_rows_and_columns_of_the_same_names(spark):
    base = [(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (2, None), (None, "x y"), (3, "w " * 30_000)]
    rows = [(i, t, "en", "s", 5, "k", True) for i, t in base]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality_report string, secrets int, language string, kept boolean").repartition(2)
    none = spark.createDataFrame([], "doc_id long, quality int")
    for got in (quality_rules.report(df, none), language_id.report(df), secret_scan.report(df), suffix_dedup.report(df), lm_score.report(df), decontamination.report(df, spark.createDataFrame([(1, "x y")], "item_id long, text string"))):
        assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "1", "2", "3", "None"]
    assert quality_rules.report(df, none).columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert quality_rules.kept(df, none).columns == df.columns and secret_scan.redacted(df).collect()[0].secrets == 5


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "f x a"), (3, "a")], "doc_id long, text string")
    post = decontamination.index(docs, spark.createDataFrame([("a",), ("f",)], "term string"))
    assert sorted((r.doc_id, r.pos, r.other) for r in decontamination.proximity(post, "a", "f", 3).collect()) == [(2, 3, 1)]
    assert sorted((r.doc_id, r.pos, r.other) for r in decontamination.proximity(post, "a", "f", 5).collect()) == [(1, 1, 6), (2, 3, 1)]


def test_near_groups(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.report(docs).collect()}
    assert got == brute.near_groups(pairs(docs))
    fewer = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.groups(docs, 80).collect()}
    assert fewer == brute.near_groups(pairs(docs), 80)
    kept = near_dedup.kept(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in got.items() if i == c)
    assert near_dedup.report(docs.limit(0)).count() == 0


def test_near_groups_of_the_small_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.report(d).collect()}
    want = brute.near_groups(pairs(d))
    assert got == want and sum(i != c for i, (_, c) in want.items()) > 50


def test_rows_of_one_doc_id(spark):
    rows = [(1, "b b", {"x": 1}), (1, "a a", {"x": 2}), (1, "a a", {"x": 1}), (2, None, None), (None, "a a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row map<string,int>")
    assert sorted(near_dedup.kept(df.repartition(3)).collect(), key=str) == sorted([(1, "a a", {"x": 1}), (2, None, None), (None, "a a", None)], key=str)


def test_limits_meet_nearly_all_pairs():
    for similarity, chunks in ((85, 12), (80, 14)):
        limit = near_dedup.Limit(similarity)
        assert (limit.chunks, limit.distance) == (chunks, 2 * chunks - 1)
    rng = np.random.default_rng(3)
    limit = near_dedup.Limit(80)
    a = rng.integers(0, 1 << 16, (1, 64), np.uint16)
    for _ in range(300):  # every pair within the distance has a key in common
        b = a.copy()
        at = rng.choice(64, limit.distance, replace=False)
        b[0, at] ^= np.uint16(1 + rng.integers(0, 1000))
        assert any((x == y).any() for x, y in zip(near_dedup._keys(a, limit), near_dedup._keys(b, limit), strict=True))


def thue_morse(n=10):
    t = "a"
    for _ in range(n):
        t += t.translate({97: 98, 98: 97})
    return t, t.translate({97: 98, 98: 97})


def test_texts_made_against_hashes_with_powers_of_two(spark):
    a, b = thue_morse()
    rows = [(i, f"{x} {y} one two three\n{x}\n{y}\n{x}") for i, (x, y) in enumerate([(a, b), (b, a)])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.report(df).collect()} == brute.near_groups(rows)
    got = {r.doc_id: r for r in quality_rules.report(df, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert all((got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words, got[i].base_failed) == brute.quality_base(t) for i, t in rows)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    scores = {r.doc_id: r for r in lm_score.report(df).collect()}
    assert all(scores[i].n_known == known and scores[i].base_score == pytest.approx(base) for i, (_, known, _, base) in brute.base_scores(rows, held).items())


def test_large_family_links_through_the_centre(spark):
    rng = random.Random(2)
    base = [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        w = list(base)
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(300)] = f"new{rng.random()}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_groups(rows)


def test_families_of_many_blocks(spark, monkeypatch):
    """Hot keys, blocks of few members, and parts of a family that have no link to its first block."""
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(near_dedup, "HOT_ROWS", 3)
    rng = random.Random(4)
    rows, heart = [], [f"{rng.choice(WORDS)}{rng.randrange(60)}" for _ in range(150)]
    for part in range(6):
        base = heart[: 150 - 9 * part] + [f"p{part}x{k}" for k in range(9 * part)]
        for _ in range(25 if part < 3 else 5):
            w = list(base)
            for _ in range(rng.randint(1, 2)):
                w[rng.randrange(150)] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_groups(rows)
    assert len({c for _, c in got.values()}) > 1


def test_components(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, 50), (50, 70), (3, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 10 for i in range(10, 41)} | {100: 50, 50: 50, 70: 50}


@pytest.mark.parametrize("hot", [4096, 0])
def test_substring_dedup(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.report(docs.repartition(7)).collect()}
    assert got == brute.substring_dedup(pairs(docs))
    assert suffix_dedup.report(docs.limit(0)).count() == 0


def test_substring_dedup_of_strings_of_just_the_length(spark):
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [noise(n) for n in (49, 50, 51, 68, 120) for _ in range(12)]
    rows = [(i, noise(rng.randint(0, 90)) + rng.choice(shared) + noise(rng.randint(0, 90)) + rng.choice(shared)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.report(df).collect()}
    assert got == brute.substring_dedup(rows)


def asked(texts, monkeypatch):
    """What a bucket answers when each text makes a segment, as a list of batches."""
    monkeypatch.setattr(suffix_dedup, "SEGMENT_BYTES", 1)
    batches = [pa.record_batch([pa.array([i]), pa.array([t])], ["doc_id", "text"]) for i, t in enumerate(texts)]
    rows = pa.Table.from_batches(suffix_dedup._pack(1)(iter(batches)))
    rows = rows.filter(pa.compute.greater_equal(rows["bucket"], 0))
    return list(suffix_dedup._repeated((pa.scalar(0),), iter(rows.to_batches())))


def test_common_phrases_shorter_than_a_key_send_no_contexts(monkeypatch):
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    phrases = [noise(24) for _ in range(40)]
    texts = ["".join(noise(40) + p for p in phrases) for _ in range(6)]
    found = [any(r) for batch in asked(texts, monkeypatch) for r in batch["repeated"].to_pylist()]
    assert found == [False] * 6
    passage = noise(60)
    found = [any(r) for batch in asked([t + passage * (i > 3) for i, t in enumerate(texts)], monkeypatch) for r in batch["repeated"].to_pylist()]
    assert found == [False] * 4 + [True] * 2


def test_a_bucket_answers_all_segments_at_once(monkeypatch):
    texts = texts_of_a_length(80)
    answers = asked(texts, monkeypatch)
    assert len(answers) == 1 and answers[0].num_rows == len(texts)
    keys = np.zeros((len(texts), suffix_dedup.ROW), np.uint8)
    keys[:, 0], keys[:, 1], keys[:, -2:] = suffix_dedup.CONTEXT, np.arange(len(texts)) // 2, (suffix_dedup.LENGTH, 1)
    runs = [(str(i), *suffix_dedup.front_coded(k[None]), np.array([i], "<i8").tobytes(), np.array([7], "<u4").tobytes()) for i, k in enumerate(keys)]
    batch = pa.record_batch([pa.array(c) for c in zip(*runs, strict=True)], ["segment", "shared", "rests", "docs", "places"])
    marks = list(suffix_dedup._merge((pa.scalar(0),), iter([batch])))
    assert len(marks) == 1 and sorted(marks[0]["segment"].to_pylist(), key=int) == [str(i) for i in range(1, len(texts), 2)]


def texts_of_a_length(n):
    rng = random.Random(13)
    return ["".join(rng.choice("abcdefgh") for _ in range(n)) for _ in range(100)]


def test_loser_tree_merges_and_shares():
    rng = random.Random(5)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(suffix_dedup.ROW)) for _ in range(rng.randint(0, 9))) for _ in range(6)]
    coded = [suffix_dedup.front_coded(np.frombuffer(b"".join(r), np.uint8).reshape(-1, suffix_dedup.ROW)) if r else (b"", b"") for r in runs]
    assert [suffix_dedup.decoded(*c) if r else [] for r, c in zip(runs, coded, strict=True)] == runs
    out, last = [], b""
    for run, place, shared in suffix_dedup.merged([(r, c[0]) for r, c in zip(runs, coded, strict=True)]):
        key = runs[run][place]
        assert key[:shared] == last[:shared] and (key == last or not last or key[shared] != last[shared])
        out.append(key)
        last = key
    assert out == sorted(k for r in runs for k in r)


def test_trigram_queries_never_lose_a_match(spark):
    rng = random.Random(4)
    pieces = ["password", "PASSWD", "api_key", "apikey", "Token", "secret", ": ", "=", '"', "' ", "AKIA", "ABCDEFGHIJ0123456789", "0123abcdef" * 3, "ghp_" + "a" * 40, "xoxb-" + "1" * 20, "eyJabc.def.ghi" * 4, "-----BEGIN RSA PRIVATE KEY-----", "é中", "\n", "ſecret=abcdefg", "K"]
    docs = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(300)] + [""]
    plain = []
    for t in docs:
        found = []
        for k, rule in enumerate(secret_scan.RULES):
            for m in re.finditer(rule.pattern, t, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0)):
                if len(m[rule.group]) >= rule.least:
                    found.append((m.start(), k, m.end()))
        plain.append([(secret_scan.RULES[k].kind, s, e) for s, k, e in sorted(found)])
    assert secret_scan.find(docs) == plain
    df = spark.createDataFrame(list(enumerate([*docs, None])), "doc_id long, text string")
    got = {r.doc_id: r for r in secret_scan.report(df).collect()}
    assert len(got) == 302 and got[301].spans == "" and all(got[i].spans == ",".join(f"{k}:{s}:{e}" for k, s, e in p) for i, p in enumerate(plain))
    kept = secret_scan.index(df.withColumn("secrets", F.lit(5)).repartition(3))
    later = (secret_scan.Rule("mark", r"中+\n", 2), secret_scan.Rule("slack", r"xox[abprs]-[0-9]+", 15))
    again = {r.doc_id: [tuple(x) for x in r.found] for r in secret_scan.search(kept, later, "found").collect()}
    for i, t in enumerate(docs):
        assert again[i] == sorted([("mark", *m.span()) for m in re.finditer("中+\n", t) if len(m[0]) >= 2] + [("slack", *m.span()) for m in re.finditer("xox[abprs]-[0-9]+", t) if len(m[0]) >= 15], key=lambda x: x[1])
    assert secret_scan.search(kept, out="found").where("secrets <> 5").count() == 0
    assert secret_scan.redacted(df.withColumn("secrets", F.lit(5)).limit(0)).columns == ["doc_id", "text", "secrets"]
    assert secret_scan.report(df.limit(0)).count() == 0 and secret_scan.report(df.union(df)).count() == 604
    long = "x " * 400_000 + "password: abcdefgh"
    assert secret_scan.find([long]) == [[("assign", 800_000, 800_018)]]
    clean = {r.doc_id: r.text for r in secret_scan.redacted(df).collect()}
    assert clean[301] is None and all(clean[i] == t for i, (t, p) in enumerate(zip(docs, plain, strict=True)) if not p)
    assert not any(k in ("access", "github", "private_key") for f in secret_scan.find([t or "" for t in clean.values()]) for k, _, _ in f)


def test_quality_base_and_verdict(spark, docs):
    rows = pairs(docs) + [(500, "a b c d e f g h " * 9), (501, "x y\nx y\n\nx y\n #|"), (502, "w%d " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.report(df, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality_base(t), i
        assert r.kept == (not r.base_failed)


def test_quality_model_on_held_out_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    model = quality_rules.train(d, labels.where(~rest))
    seen = quality_rules.assess(d.join(labels.where(rest), "doc_id"), model).select("quality", "quality_report.*").where("NOT base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in seen) >= 0.95 * len(seen)


def test_language_on_held_out_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.report(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "de"), (3, "123 !!", "en"), (4, "中文", None), (5, "the of and", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.report(odd).collect()}
    assert got[1] == got[2] == got[3] == "und"


def test_base_scores_and_probabilities(spark, docs):
    rows = pairs(docs)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    got = {r.doc_id: r for r in lm_score.report(docs).collect()}
    for i, (n, known, train, base) in brute.base_scores(rows, held).items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), n, known, train)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score < 0


def test_scores_use_every_counted_context(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(0, 2500)))) for i in range(40)] + [(40, None), (41, "a"), (42, "Q~"), (43, "a")]
    counts = {}  # the symbols seen after each context, counted over the training rows
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            s = [*(t or "").encode(), lm_score.END]
            for at, symbol in enumerate(s):
                for k in range(min(at, lm_score.ORDER - 1) + 1):
                    seen = counts.setdefault(tuple(s[at - k : at]), {})
                    seen[symbol] = seen.get(symbol, 0) + 1
    assert len(counts) > 30_000

    def p(context, symbol):
        seen = counts.get(context, {})
        n = sum(seen.values())
        if not context:
            return (seen.get(symbol, 0) + 1) / (n + lm_score.END + 1)
        return (seen.get(symbol, 0) + len(seen) * p(context[1:], symbol)) / (n + len(seen)) if seen else p(context[1:], symbol)

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in lm_score.report(df).collect()}
    for i, t in rows:
        s = (*(t or "").encode(), lm_score.END)
        assert got[i] == pytest.approx(sum(np.log10(p(s[max(0, k - lm_score.ORDER + 1) : k], s[k])) for k in range(len(s))), rel=1e-5)
    unseen = lm_score.report(df.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)).collect()
    assert unseen and all(r.score == pytest.approx(-np.log10(257) * (len((dict(rows)[r.doc_id] or "").encode()) + 1), rel=1e-5) for r in unseen)
    assert lm_score.report(df.limit(0)).count() == 0


def test_automaton_is_a_distribution_and_carries_its_state():
    data, offs = textbuf.buffers(pa.array(["abracadabra", "abba", ""]))
    codes, counts = np.unique(lm_score.end_windows(data, offs), return_counts=True)
    contexts, arcs = {(0, 0)}, {}
    bits = lm_score._BITS
    for code, n in zip(codes.tolist(), counts.tolist(), strict=True):
        symbols = [code >> bits * (lm_score.ORDER - 1 - k) & 511 for k in range(lm_score.ORDER)]
        for k in range(lm_score.ORDER):
            if lm_score.END in symbols[:k]:
                break
            context = (k, sum(s << bits * (k - 1 - j) for j, s in enumerate(symbols[:k])))
            contexts.add(context)
            arcs.setdefault(context, {})
            arcs[context][symbols[k]] = arcs[context].get(symbols[k], 0) + n
    a = lm_score.Automaton(sorted(contexts), {c: sorted(x.items()) for c, x in arcs.items()}, sum(arcs[(0, 0)].values()))
    assert np.allclose((10.0 ** a.table.astype(float)).sum(axis=1), 1, atol=1e-4)
    text = "abracadabra" * 400  # several chunks
    one, total = a.root, 0.0
    for s in [*text.encode(), lm_score.END]:
        total += float(a.table[one, s])
        one = a.next[one, s]
    assert a.score(*textbuf.buffers(pa.array([text, "abba"])))[0] == pytest.approx(total, rel=1e-5)


def test_warc_round_trip(spark, tmp_path):
    html = [None, "", "short", "é" * 49 + "a", "p" * 99, "p" * 100, "p" * 100, "q" * 200000, "p" * 100, "q" * 200000, "short"]
    rows = [(i, f"http://x/{i}\n" if i else None, h) for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in warc_bundles.report(pages).collect()}
    assert [(got[i].record_type, got[i].refers_to, got[i].payload_bytes) for i in range(11)] == [(("revisit", {6: 5, 8: 5, 9: 7}[i]) if i in (6, 8, 9) else ("response", None)) + (len((html[i] or "").encode()),) for i in range(11)]
    folder = str(tmp_path / "bundles")
    index = warc_bundles.write(warc_bundles.assigned(pages), folder)
    one = warc_bundles.lookup(index, folder, [7]).collect()
    assert [bytes(r.payload) for r in one] == [b"q" * 200000]
    assert warc_bundles.report(pages.limit(0)).count() == 0


def plain_licenses(model, text):
    """{family: paragraphs} of one text, line by line."""
    known, lines = license_scan.Templates(), {}
    for n, line in enumerate((text or "").split("\n")):
        words = license_scan.tokens(line)
        p, own = model.probabilities(words), license_scan.shingles(words)
        family = model.families[int(p.argmax())]
        met = [s for s in own if s in known.of.get(family, ())]
        if family != license_scan.UNKNOWN and p.max() >= model.threshold and len(met) >= license_scan.MIN_SHARE * len(own) and any(s in known.distinctive for s in met):
            lines.setdefault(family, []).append(n)
    return {f: sum(n - 1 not in at for n in at) for f, at in lines.items()}


def test_licenses(spark):
    body = license_scan.FAMILIES["mit"][2]
    wrapped = "\n".join(textwrap.wrap("  ".join(license_scan.FAMILIES["bsd"][2]), 76))
    expected = {
        "Some words.\nReleased under the MIT License.\nMore.": ("mit", 1), license_scan.FAMILIES["gpl"][2][0]: ("gpl", 1), license_scan.NEUTRAL[0]: (None, 0), "": (None, 0), body[2]: ("mit", 1),
        "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.": ("cc", 3), "Redistribution and use in source and binary forms are permitted provided that the conditions are met": ("bsd", 1),
        "Eclipse Public License, Version 2.0": ("epl", 1), "ISC License": ("isc", 1), "Released under the Unlicense": ("unlicense", 1), "GNU Affero General Public License": ("agpl", 1), "SPDX-License-Identifier: ISC": ("isc", 1),
        "Distributed under the GPL v3.": ("gpl", 1), "This project uses the BSD 2-Clause License.": ("bsd", 1), "LGPL 2.1": ("lgpl", 1), "CC0 1.0 Universal": ("cc0", 1), "Boost Software License": ("boost", 1), "Business Source License 1.1": ("busl", 1),
        "Licensed under the Foo Public License.": (None, 0), "SPDX-License-Identifier: X11": (None, 0), "Artistic License 2.0": (None, 0), "European Union Public Licence": (None, 0), "word " * 200_000 + "MIT": (None, 0),
    }
    rows = [(i, t, "x", i) for i, t in enumerate(expected)] + [(900, None, "x", 0), (None, "ISC License", "x", 0), (901, "ISC License", "x", 1), (901, "MIT License", "x", 2), (902, wrapped, "x", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, paragraph string, row int").repartition(5)
    got = license_scan.report(df)
    seen = {r.doc_id: (r.family, r.n_paragraphs) for r in got.collect()}
    assert [seen[i] for i in range(len(expected))] == list(expected.values())
    assert got.count() == len(rows) and seen[900] == seen[None] == (None, 0) and seen[901] == ("isc", 2)
    assert seen[902][0] == "bsd" and seen[902][1] >= 1 and {r.doc_id: r.families for r in got.collect()}[902] == "bsd"
    assert {r.families for r in got.collect() if r.family == "cc"} == {"apache,cc"}
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert license_scan.report(df.limit(0)).count() == 0


def test_licenses_against_plain_loops(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    pieces = [" ".join(w for w in t.split()[::k]) for f in license_scan.FAMILIES for t in license_scan.templates(f) for k in (1, 2)] + license_scan.NEUTRAL
    rows = pairs(d) + [(10_000_000 + i, t) for i, t in enumerate(pieces)]
    model, found = license_scan.classifier(), 0
    got = {r.doc_id: r for r in license_scan.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = plain_licenses(model, t)
        assert (got[i].n_paragraphs, got[i].families) == (sum(want.values()), ",".join(sorted(want))), t
        found += bool(want)
    assert found > 200


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, got = docs.columns, docs
    for name, stage in p.STAGES:
        before = {r.doc_id: r.text for r in got.select("doc_id", "text").collect()}
        got = stage(spark, got, DATA).cache()
        if name == "near_duplicates":
            groups = brute.near_groups(before.items(), 80)
            assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
            assert {r.doc_id for r in got.collect()} == {r[0] for r in brute.contamination(before.items(), items) if not r[5]}
        if name != "sentencepiece":
            assert got.columns == columns
    assert got.where("NOT exact").count() == 0 and got.count() == len(before)
