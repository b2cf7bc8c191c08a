"""The corpus operators against brute-force versions on small tables, with missing, empty, long, tied and repeated rows."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from graticule.llm import (
    op1_token_counts as op1, op2_merkle as op2, op3_mixture as op3, op4_pii as op4, op5_simhash as op5, op6_token_files as op6,
    op7_toxicity as op7, op8_quality as op8, op9_packing as op9, op10_language as op10, queries,
)
from graticule.llm.encoding import Encoder

BYTE, WORD = queries.vocabulary(queries.BYTE_BPE), queries.vocabulary(queries.WORD_BPE)
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("fp", "block", "copy", "size", "g", "h", "row", "takes", "shard", "length", "toxic", "kept")],
])


def table(spark, rows):
    """Documents (doc_id, text, lang, source) with many other columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), *["x"] * 12) for i, t, lang, s in rows], SCHEMA)


LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = [
    (5, None, None, None), (None, "no id at all here.", "en", "a"), (7, "", "en", "b"), (9, LONG, "en", "a"), (11, "Tie one. Two!", "de", "a"),
    (12, "Tie one. Two!", "de", "a"), (11, "Tie one. Two!", "de", "a"), (13, "mañana 日本語 😀 ß.\n\nSecond\nthird", "es", "b"), (14, " \n\t ", None, None),
    (15, "nul\u0000 and \x1c sep \x85 next", "en", "c"), (None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


# --- encoding ---------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoders():
    return Encoder(BYTE, True, keep=500), Encoder(WORD, False, keep=500)


def test_encoder_equals_whole_texts(encoders, rows):
    for enc in encoders:
        for text in [t for _, t, _, _ in rows] + [t for _, t, _, _ in ODD if t]:
            assert enc.encode(text) == enc.whole(text)
        assert enc.encode(None) == enc.encode("") == b""


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r.,'sS12éÉ́ 　\x0bİΣ<|>"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_encoder_equals_any_text(encoders, text):
    for enc in encoders:
        assert enc.encode(text) == enc.whole(text)


def test_special_strings_are_ordinary_text(encoders):
    for enc in encoders:
        text = "a <|endoftext|> b<|startoftext|>"
        assert enc.encode(text) == enc.whole(text)
        assert 50256 not in np.frombuffer(enc.encode(text), "<u4")


# --- 1 ----------------------------------------------------------------------------------------------------------------

def test_histogram_answers(spark, docs, rows, encoders, empty, odd):
    lengths = [len(encoders[0].whole(t or "")) // 4 + 1 for _, t, _, _ in rows]
    answers = op1.token_counts(docs, BYTE)
    got = {r["n_tokens"]: r for r in answers.collect()}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(lengths)
    for k, r in got.items():
        assert r["docs_longer"] == sum(n > k for n in lengths) and r["tokens_longer"] == sum(n for n in lengths if n > k)
        assert r["truncated_tokens"] == sum(min(n, k) for n in lengths) and r["total_tokens"] == sum(lengths)
    for limit in (0, 1, 100, 333, 10**7):
        r = op1.truncated_total(answers, limit).first()
        assert (r["tokens"], r["docs_cut"]) == (sum(min(n, limit) for n in lengths), sum(n > limit for n in lengths))
    assert op1.length_quantile(answers, 0.5).first()["n_tokens"] == sorted(lengths)[-(-len(lengths) // 2) - 1]
    assert op1.token_counts(empty, BYTE).count() == 0
    assert op1.truncated_total(op1.token_counts(empty, BYTE), 5).first()["tokens"] == 0
    assert op1.token_counts(odd, BYTE).agg(F.sum("n_docs")).first()[0] == len(ODD)


# --- 2 ----------------------------------------------------------------------------------------------------------------

def edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        m = len(text) // 3
        out.append((doc_id, len(text), hashlib.sha256((text[:len(text) - m] + following[:m]).encode()).hexdigest()))
    return Counter(out)


def merkle(text):
    node = lambda s: hashlib.sha256(s.encode()).hexdigest()
    sections = []
    for section in text.split("\n\n"):
        parts = []
        for paragraph in section.split("\n"):
            leaves = [node(p)[:16] for p in re.findall(r"[^.!?]{1,32}[.!?]*|[.!?]+", paragraph)]
            parts.append((node("".join(leaves))[:16], "".join("~" + x[:8] for x in leaves)))
        sections.append((node(",".join(h for h, _ in parts))[:16], ",".join(h + s for h, s in parts)))
    return node(";".join(h for h, _ in sections)) + "|" + ";".join(f"{h}:{s}" for h, s in sections)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_fingerprints_and_edits(request, which):
    frame = request.getfixturevalue(which)
    given_rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    got = op2.fingerprints_and_edits(frame).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == edited(given_rows)
    assert Counter(r["fingerprint"] for r in got) == Counter(merkle(t or "") for _, t in given_rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_small_blocks_give_the_same_neighbours(odd, docs):
    for frame in (docs, odd):
        base = frame.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        one = op2.with_next(base, ["text"], rows_per_block=10**9).collect()
        many = op2.with_next(base, ["text"], rows_per_block=2).collect()
        assert Counter(one) == Counter(many) and len(one) == base.count()


def test_likeness_and_changed_branches(spark):
    a, b = "One. Two.\nThree here.\n\nLast section.", "One. Two.\nThree there.\n\nLast section."
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        op2.fingerprint(F.col("a")).alias("a"), op2.fingerprint(F.col("b")).alias("b"))
    got = row.select(
        op2.changed_branches(F.col("a"), F.col("b")).alias("c"), op2.changed_branches(F.col("a"), F.col("a")).alias("same"),
        op2.likeness(F.col("a"), F.col("b")).alias("l"), op2.likeness(F.col("a"), F.col("a")).alias("one")).first()
    assert got["c"] == ["0.1"] and got["same"] == [] and got["l"] == 0.75 and got["one"] == 1.0


def test_edits_stay_near(docs):
    got = op2.fingerprints_and_edits(docs).where("n_chars > 300").agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert 0.55 < got[0] < 0.8 and got[1] < 0.1


# --- 3 ----------------------------------------------------------------------------------------------------------------

def targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        share = {s: (goal - sum(capped.values())) * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_mix_meets_targets(request, which):
    frame = request.getfixturevalue(which)
    given_rows = [(r["doc_id"], r["source"], len(SPLIT.findall(r["text"] or ""))) for r in frame.collect()]
    got = op3.mixed_documents(frame).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n) for i, _, n in given_rows)
    sizes, source = defaultdict(int), {}
    for i, s, n in given_rows:
        sizes[s] += n
    want = targets(sizes)
    by_target = defaultdict(int)
    for r in got:
        by_target[round(r["target"], 6), r["source_size"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    expected = defaultdict(int)
    for s, t in want.items():
        expected[round(t, 6), sizes[s]] += round(t)
    assert {k: pytest.approx(v, abs=3) for k, v in expected.items()} == by_target
    assert Counter(got) == Counter(op3.mixed_documents(frame).collect())
    times = [r["position"] for r in got if r["position"] is not None]
    assert times == sorted(times) and all(0 <= t <= 1 for t in times)


def test_mix_of_nothing(empty):
    assert op3.mixed_documents(empty).count() == 0 and op3.training_order(empty).count() == 0


def test_demand_is_inverted(spark):
    frame = spark.range(101).select((F.col("id") / 100).alias("u"))
    for k, knots in enumerate(op3.SCHEDULES):
        x, y = zip(*knots)
        grid = np.linspace(0, 1, 200_001)
        strength = np.interp(grid, x, y)
        area = np.concatenate([[0], np.cumsum((strength[1:] + strength[:-1]) / 2)])
        for r in frame.select("u", op3.demand_time(F.col("u"), F.lit(k)).alias("t")).collect():
            assert np.interp(r["t"], grid, area / area[-1]) == pytest.approx(r["u"], abs=1e-6)


def test_training_order_repeats_whole_rows(docs, rows):
    out = op3.training_order(docs)
    assert out.columns == docs.columns
    passes = {r["doc_id"]: r["passes"] for r in op3.mixed_documents(docs).collect()}
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: v for k, v in passes.items() if v})


# --- 4 ----------------------------------------------------------------------------------------------------------------

def base_by_rule(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d))))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), "phone", m.end()))
    return out


def test_base_spans_follow_the_rule(rows):
    for _, text, _, _ in rows:
        assert sorted(op4.base_spans(text)) == sorted(base_by_rule(text))


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("a_b@.-+%0123459() \n:é😀"), max_size=60))
def test_base_spans_on_any_text(text):
    assert sorted(op4.base_spans(text)) == sorted(base_by_rule(text))


def test_added_spans():
    kinds = lambda t: [k for _, k, _, _ in op4.find_spans(t)]
    assert kinds("iban DE89 3704 0044 0532 0130 00 thanks") == ["iban"]
    assert "iban" not in kinds("iban DE89 3704 0044 0532 0130 01 thanks")
    assert kinds("please call 555 123 4567 now") == ["local_phone"] and kinds("rows 555 123 4567 now") == []
    assert kinds("mail a.b@c.org,x@y.z") == ["email", "email"]
    assert op4.redact("to a@b.cd!", op4.find_spans("to a@b.cd!")) == "to <EMAIL>!"
    assert op4.find_spans(None) == op4.find_spans("") == []
    assert op4.find_spans("9" * 200_000) == [] and op4.find_spans("1." * 100_000 + "@" * 1000) is not None


@pytest.mark.parametrize("iban", [
    "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00",
    "CZ65 0800 0000 1920 0014 5399", "AT611904300234573201", "NO93 8601 1117 947"])
@pytest.mark.parametrize("behind", ["", " BIC GIBAATWW", " EUR 50", " BANK", " GIBAATWWXXX", " thanks", " AB1", " ES91 2100 0418 4502 0005 1332 EUR"])
def test_ibans_before_words_and_codes(iban, behind):
    for before in ("iban ", "account AB12 "):
        text = before + iban + behind
        found = [text[a:b] for a, k, b, _ in op4.find_spans(text) if k == "iban"]
        assert found == [iban] + ["ES91 2100 0418 4502 0005 1332"] * ("ES91" in behind)


def test_many_spans_take_linear_time():
    text = "".join(f"write to user{i}@mail{i}.org or call 555 {i % 900 + 100} {i % 9000 + 1000} now, " for i in range(40_000))
    start = time.process_time()
    spans = op4.find_spans(text)
    assert len(spans) == 80_000 and time.process_time() - start < 20


def test_added_spans_overlap_no_other(rows):
    texts = [t for _, t, _, _ in rows if t][:80] + ["call 555 123 4567 89, 10.0.0.1 555 123 4567@x.org +1 555 123 4567 DE89 3704 0044 0532 0130 00"]
    for text in texts:
        spans = op4.find_spans(text)
        for a, k, b, _ in spans:
            if k not in op4.BASE:
                assert sum(x < b and a < y for x, _, y, _ in spans) == 1


def test_pii_digest(odd, empty, spark):
    text = "ß a@b.cd +1 (743) 555-3824 10.0.0.1 4111 1111 1111 1111"
    got = op4.digest(table(spark, [(1, text, None, None)])).first()
    spans = sorted(base_by_rule(text), key=lambda s: (s[0], op4.KINDS.index(s[1])))
    written = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
    assert got["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
    assert (got["n_email"], got["n_ip"], got["n_card"], got["n_phone"]) == tuple(Counter(k for _, k, _ in spans)[k] for k in op4.BASE)
    assert op4.digest(odd).count() == len(ODD) and op4.digest(empty).count() == 0
    assert op4.span_table(table(spark, [(1, text, None, None)])).count() == len(spans)
    out = op4.redacted(odd)
    assert out.columns == odd.columns and out.where("text IS NULL").count() == 2


# --- 5 ----------------------------------------------------------------------------------------------------------------

def slow_simhash(text):
    words = SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps):
    """Smallest id by links of all pairs of distinct fingerprints."""
    distinct = sorted({f for _, f in fps})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= 3:
            root[find(a)] = find(b)
    least = defaultdict(list)
    for i, f in fps:
        least[find(f)].append(i)
    return Counter((i, f"{f:016x}", min((x for x in least[find(f)] if x is not None), default=None)) for i, f in fps)


@pytest.mark.parametrize("which", ["docs", "odd", "empty"])
def test_near_duplicates(request, which):
    frame = request.getfixturevalue(which)
    fps = [(r["doc_id"], slow_simhash(r["text"])) for r in frame.collect()]
    assert Counter(map(tuple, op5.near_duplicates(frame).collect())) == groups(fps)


def test_links_and_groups_of_planted_fingerprints(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 64, 60, dtype=np.uint64)]
    fps = set(base)
    for f in base[:20]:  # chains, so groups are wider than a link
        for _ in range(12):
            for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                f ^= 1 << int(bit)
            fps.add(f)
    fps |= {base[30] ^ (1 << a) ^ (1 << b) for a in range(20, 40) for b in range(a)}  # a dense ball
    signed = lambda f: f - (1 << 64) * (f >= 1 << 63)
    frame = spark.createDataFrame([(i, signed(f)) for i, f in enumerate(sorted(fps))], "doc_id long, fp long")
    got = {(r["a"], r["b"]) for r in op5.links(frame).collect()}
    want = {tuple(sorted((signed(a), signed(b)))) for a, b in itertools.combinations(sorted(fps), 2) if (a ^ b).bit_count() <= 3}
    assert got == want
    classes = {r["fp"]: r["rep_id"] for r in op5.classes(frame).collect()}
    expect = groups(list(enumerate(sorted(fps))))
    assert Counter((i, f"{f:016x}", classes[signed(f)]) for i, f in enumerate(sorted(fps))) == expect


def test_one_of_each_group(docs, odd, empty):
    for frame in (docs, odd, empty):
        out = op5.one_of_each_group(frame)
        assert out.columns == frame.columns
        classes = groups([(r["doc_id"], slow_simhash(r["text"])) for r in frame.collect()])
        assert out.count() == len({c if c is not None else f for _, f, c in classes})
        kept = {r["doc_id"] for r in out.collect() if r["doc_id"] is not None}
        assert kept == {c for _, _, c in classes if c is not None}


# --- 6 ----------------------------------------------------------------------------------------------------------------

def order_by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, docs, rows, encoders, tmp_path, encoding):
    path = f"{tmp_path}/tokens"
    op6.write_tokens(docs, path, BYTE, encoding=encoding, docs_per_file=37)
    got = {r["doc_id"]: r for r in op6.token_index(spark, path).collect()}
    start = 0
    for doc_id, text, *_ in order_by_id(rows):
        packed = encoders[0].whole(text) + b"\0\0\0\0"
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(packed) // 4, zlib.crc32(packed))
        start += len(packed) // 4
    some = op6.read_tokens(spark, path, [3, 50]).collect()
    assert {r["doc_id"] for r in some} == {3, 50}
    frames = list(op6.token_frames(spark, path))
    assert [i for f in frames for i in f["doc_id"]] == [r[0] for r in order_by_id(rows)]


def test_token_files_of_odd_tables(spark, odd, empty, encoders, tmp_path):
    op6.write_tokens(odd, f"{tmp_path}/odd", BYTE)
    got = op6.token_index(spark, f"{tmp_path}/odd").collect()
    start, want = 0, []
    for doc_id, text, *_ in order_by_id(ODD):
        packed = encoders[0].whole(text or "") + b"\0\0\0\0"
        want.append((doc_id, start, len(packed) // 4, zlib.crc32(packed)))
        start += len(packed) // 4
    assert Counter(map(tuple, got)) == Counter(want)
    op6.write_tokens(empty, f"{tmp_path}/empty", BYTE)
    assert op6.token_index(spark, f"{tmp_path}/empty").count() == 0


# --- 7 ----------------------------------------------------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark, sf_dir):
    data = sf_dir.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    docs = spark.read.parquet(f"{data}/documents.parquet").join(labels.select("doc_id"), "doc_id")
    got = op7.toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got)
    right = sum(r["predicted"] == r["toxic"] for r in got) / len(got)
    hit = [r["predicted"] for r in got if r["toxic"]]
    assert right > 0.95 and sum(hit) / len(hit) > 0.7


def as_rows(lists):
    return np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.concatenate([np.asarray(x, np.int64) for x in lists])


def test_pairwise_score_equals_a_double_loop():
    rng = np.random.default_rng(0)
    model = op7.FactorizationMachine(np.arange(40) * 3, -0.3)
    model.w, model.v = rng.normal(size=40).astype(np.float32), rng.normal(size=(40, 4)).astype(np.float32)
    texts = [sorted(rng.choice(40, k, replace=False).tolist()) for k in (0, 1, 2, 7, 40)]
    sizes = np.array([1, 1, 5, 7, 30])
    z = model.logits(*as_rows(texts), sizes)
    for got, features, n in zip(z, texts, sizes):
        want = model.b + sum(float(model.w[i]) for i in features)
        want += sum(float(model.v[i].astype(float) @ model.v[j].astype(float)) for i, j in itertools.combinations(features, 2)) / n ** 0.5
        assert got == pytest.approx(want, abs=1e-4)
        assert model.score(features, n) == pytest.approx(1 / (1 + np.exp(-want)), abs=1e-4)
    assert model.places([0, 1, 6, 117, 118]) == [0, 2, 39]


def test_one_batch_of_the_fit_equals_plain_gradients():
    rng = np.random.default_rng(1)
    texts = [sorted(rng.choice(6, k, replace=False).tolist()) for k in (1, 3, 4, 0, 2)]
    y, weight = np.array([1, 0, 1, 0, 1], np.float32), np.array([1, 2, 1, 1, 3.0])
    model = op7.FactorizationMachine(np.arange(6), 0.2, factors=2)
    b, w, v = model.b, model.w.astype(float), model.v.astype(float)
    x = np.zeros((5, 6))
    for i, t in enumerate(texts):
        x[i, t] = 1
    root = np.sqrt([max(len(t), 1) for t in texts])
    z = b + x @ w + np.array([sum(v[i] @ v[j] for i, j in itertools.combinations(t, 2)) for t in texts]) / root
    g = (1 / (1 + np.exp(-z)) - y) * weight / weight.mean() / 5
    dw = x.T @ g
    dv = np.array([sum((g[r] / root[r] * (sum(v[j] for j in t) - v[i]) for r, t in enumerate(texts) if i in t), start=np.zeros(2)) for i in range(6)])
    model.fit(*as_rows(texts), root ** 2, y, weight, epochs=1, batch=5, alone=0, rate=0.3, sparse=0.01, pairs=0.002, damp=0.01)
    step = 0.3 / np.sqrt(0.01 + dw ** 2)
    moved = w - step * dw
    assert model.b == pytest.approx(b - 0.3 * g.sum() / np.sqrt(0.01 + g.sum() ** 2))
    at = model.terms
    assert set(range(6)) - set(at.tolist()) == set(range(6)) - {i for t in texts for i in t}  # what no text has says nothing
    assert np.allclose(model.w, (np.sign(moved) * np.maximum(np.abs(moved) - step * 0.01, 0))[at], atol=1e-5)
    step = 0.3 / np.sqrt(0.01 + (dv ** 2).mean(1))[:, None]
    size = np.maximum(np.linalg.norm(step * dv, axis=1, keepdims=True), 1e-12)
    assert np.allclose(model.v, (v - step * dv * np.maximum(1 - step * 0.002 / size, 0))[at], atol=1e-5)


def test_toxicity_learns_a_pair_of_neutral_terms():
    """Terms 0 and 1 are as common in toxic as in other texts; only together do they say something.  5,000 other words."""
    rng = np.random.default_rng(7)
    texts, y = [], []
    for i in range(6000):
        own = [[0, 1], [], [0], [1]][i % 4]
        texts.append(sorted({*own, *(2 + rng.integers(0, 5000, 25)).tolist()}))
        y.append(i % 4 == 0)
    # Both are in half of the toxic texts and in half of the others: texts without either are toxic as often as not.
    for i in range(1, 6000, 4):
        y[i] = True
    starts, features = as_rows(texts[:5000])
    model = op7.FactorizationMachine(np.arange(5002), 0.0).fit(starts, features, np.full(5000, 25), np.array(y[:5000], np.float32), np.ones(5000))
    right = [(model.score(model.places(t), 25) > 0.5) == want for t, want in zip(texts[5000:], y[5000:])]
    assert np.mean(right) > 0.95
    others = sorted((2 + rng.integers(0, 5000, 25)).tolist())
    score = lambda *own: model.score(model.places([*own, *others]), 25)
    assert score(0, 1) > 0.5 > max(score(0), score(1))
    # Without the pairs nothing is learned.
    flat = op7.FactorizationMachine(np.arange(5002), 0.0).fit(starts, features, np.full(5000, 25), np.array(y[:5000], np.float32), np.ones(5000), alone=10)
    assert np.mean([(flat.score(flat.places(t), 25) > 0.5) == want for t, want in zip(texts[5000:], y[5000:])]) < 0.6


def test_toxicity_of_odd_tables(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(9, 1), (9, 0), (11, 0), (12, None), (13, 0), (None, 1)], "doc_id long, toxic int")
    for labels in (none, some):
        got = op7.toxicity(odd, labels).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
        assert op7.toxicity(empty, labels).count() == 0


# --- 8 ----------------------------------------------------------------------------------------------------------------

def counts_by_rule(text):
    text = text or ""
    words = SPLIT.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = [], 0
    for line in text.split("\n"):
        if SPLIT.search(line):
            dup += line in seen
            seen.append(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_counts(docs, rows, odd, empty):
    for frame, given_rows in ((docs, rows), (odd, ODD)):
        got = op8.quality(frame).collect()
        want = Counter((i, *(c := counts_by_rule(t)), c[0] < 50 or 100 * c[4] > 50 * c[0]) for i, t, _, _ in given_rows)
        assert Counter(tuple(r)[:7] for r in got) == want
        assert not any(r["kept"] and r["base_failed"] for r in got)
        out = op8.good_documents(frame)
        assert out.columns == frame.columns and out.count() == sum(r["kept"] for r in got)
    assert op8.quality(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n#é "), max_size=120))
def test_quality_counts_on_any_text(text):
    assert op8.Rules().measure(text)[:5] == counts_by_rule(text)


def test_compression_bands():
    rng, rules = np.random.default_rng(0), op8.Rules()
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(4000)]
    clean = " ".join(words)
    assert rules.measure(clean)[-1]
    noise = " ".join("".join(map(chr, rng.integers(33, 127, 20))) for _ in range(600))
    assert not rules.measure(noise)[-1]
    shout = clean[:9000] + " " + " ".join(f"buy{i % 7}{i % 11} now{i % 13}" for i in range(6000))
    assert not rules.measure(shout)[-1]
    data = clean.encode()
    ratio, bad = rules.compression(data)
    assert ratio == len(zstandard.ZstdCompressor(level=3).compress(data)) / len(data) and bad == 0


def test_tails_and_short_texts_are_measured():
    rng, rules = np.random.default_rng(1), op8.Rules()
    prose = " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(2000))
    noise = "".join(map(chr, rng.integers(33, 127, 4095)))
    line = "the same line again and again\n" * 100
    assert rules.measure(prose[:4096] + noise)[-2:] == (0.5, False)
    assert rules.measure(prose[:4096] + line[:3000])[-2:] == (0.5, False)
    assert not rules.measure(prose[:2000] + noise[:1900])[-1] and not rules.measure(prose[:900] + noise[:1000])[-1]
    for size in (600, 1500, 2048, 3000, 4095, 4096, 4097, 5000, 8191):
        assert rules.measure(prose[:size])[-2:] == (0.0, True)


def test_good_documents_stay(spark, sf_dir):
    data = sf_dir.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{data}/labels.parquet").where("quality = 1")
    got = op8.quality(spark.read.parquet(f"{data}/documents.parquet")).join(labels, "doc_id").where("NOT base_failed")
    assert got.where("NOT kept").count() == 0


# --- 9 ----------------------------------------------------------------------------------------------------------------

def check_packing(got, given_rows, enc):
    want = []
    for doc_id, text, *_ in given_rows:
        packed = enc.whole(text or "") + b"\0\0\0\0"
        for n, at in enumerate(range(0, len(packed), 4 * op9.CAPACITY)):
            part = packed[at:at + 4 * op9.CAPACITY]
            want.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
    assert Counter(tuple(r)[:5] for r in got) == Counter(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= op9.CAPACITY
    return len(bins), -(-sum(r["length"] for r in got) // op9.CAPACITY)


def test_packing(docs, rows, odd, empty, encoders):
    check_packing(op9.packed_documents(odd, WORD).collect(), ODD, encoders[1])
    bins, least = check_packing(op9.packed_documents(docs, WORD).collect(), rows, encoders[1])
    assert bins <= least * 1.02 + 1
    assert op9.packed_documents(empty, WORD).count() == 0


def test_best_two_fit_replaces_the_smallest():
    counts = np.zeros(101, np.int64)
    for n in (60, 30, 21, 19):
        counts[n] += 1
    assert op9.best_two_fit(counts, 100)[0] == ([60, 21, 19], 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plans_use_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=65)
    plan = op9.best_two_fit(counts, 64)
    used = np.zeros(65, np.int64)
    for bin_, times in plan:
        assert sum(bin_) <= 64 and times > 0
        np.add.at(used, bin_, times)
    assert (used == counts).all()


def test_plans_stay_small():
    rng = np.random.default_rng(0)
    counts = np.bincount(rng.integers(1, 2049, 3_000_000), minlength=2049)
    plan = op9.best_two_fit(counts)
    assert len(plan) < 20_000
    assert sum(t for _, t in plan) <= 1.01 * -(-(counts * np.arange(2049)).sum() // 2048)


def test_sequences_carry_ids(spark, docs, rows, encoders):
    packed = op9.pack(op9.pieces(docs, WORD, with_ids=True).cache())
    total = op9.sequences(packed).agg(F.sum(F.size("ids"))).first()[0]
    assert total == sum(len(encoders[1].whole(t)) // 4 + 1 for _, t, _, _ in rows)


# --- 10 ---------------------------------------------------------------------------------------------------------------

def test_languages_of_held_out_rows(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    got = op10.languages(frame).where("held_out").join(frame.select("doc_id", "lang"), "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    assert sum(r["lang_pred"] == r["lang"] for r in got) / len(got) > 0.95
    assert sum(r["rejected"] for r in got) / len(got) < 0.05


def test_languages_of_odd_tables(odd, empty, docs):
    got = op10.languages(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "es", "und")
    assert {r["lang_pred"] for r in got if r["doc_id"] in (5, 7, 14)} == {"und"}
    assert op10.languages(empty).count() == 0
    untaught = op10.languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}


def test_more_languages_than_two_hundred(spark):
    rng = np.random.default_rng(8)
    letters, rows = list("abcdefghijklmnopqrstuvwxyz"), []
    for lang in range(230):
        words = ["".join(rng.choice(letters, 6)) for _ in range(12)]
        rows += [(lang * 10 + i, " ".join(rng.choice(words, 30)), f"l{lang:03}", "a") for i in range(10)]
    frame = table(spark, rows)
    want = {i: lang for i, _, lang, _ in rows}
    got = op10.languages(frame).collect()
    assert len({r["lang_pred"] for r in got}) == 230
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in got) / len(got) > 0.98


def test_vectors_and_clusters_equal_plain_versions(docs):
    texts = [r["text"] for r in docs.limit(60).collect() if r["text"]]
    counts = [c for c in map(op10.ngram_counts, texts) if c is not None]
    idf = np.log((1 + len(counts)) / (1 + sum((c > 0).astype(float) for c in counts))) + 1
    plain = []
    for c in counts:
        x = [float(np.float16(np.log1p(v))) * w for v, w in zip(c.tolist(), idf)]
        size = sum(v * v for v in x) ** 0.5
        plain.append([v / size for v in x])
    x = op10.weigh(op10.damped(np.stack(counts)), idf.astype(np.float32))
    assert np.allclose(x, plain, atol=1e-5)
    centers, own = op10.spherical_kmeans(x, 3)
    for i, row in enumerate(plain):
        assert own[i] == max(range(3), key=lambda j: sum(a * b for a, b in zip(row, centers[j])))
    for j in range(3):
        mean = np.array(plain)[own == j].mean(0)
        assert np.allclose(centers[j], mean / np.linalg.norm(mean), atol=2e-2)
    model = op10.Centroids(["a", "b"], idf.astype(np.float32), centers, np.array([0, 1, 1]), np.array([0.0, 0.0, 2.0]))
    for c, row, (lang, score, rejected) in zip(counts, plain, model.predict(counts)):
        near = [sum(a * b for a, b in zip(row, v)) for v in centers]
        best = near.index(max(near))
        assert lang == "abb"[best] and score == pytest.approx(near[best], abs=1e-4) and rejected == (best == 2)


def test_repeated_ids_teach_once(spark):
    rows_ = [(1, "aaa bbb", "xx", "a")] * 2000 + [(i, "ccc ddd", "yy", "a") for i in range(3, 40)] + [(i, "aab bba", "xx", "a") for i in range(100, 140)]
    assert op10.sample(table(spark, rows_), 50).groupBy("lang").count().where("count > 50").count() == 0
    taught = op10.sample(table(spark, rows_), 50).where("lang = 'xx'").collect()
    assert sum(r["text"] == "aaa bbb" for r in taught) == 1


def test_foreign_text_is_rejected(docs, spark):
    model = op10.fit(docs)
    foreign = "Это совершенно другой язык, которого модель никогда не видела. " * 20
    (_, _, rejected), (lang, _, known) = model.predict([op10.ngram_counts(foreign), op10.ngram_counts(docs.where("lang = 'de'").first()["text"])])
    assert rejected and lang == "de" and not known


def test_long_texts_count_in_pieces():
    text = "Ein Wort. " * 150_000
    a, b = op10.ngram_counts(text), op10.ngram_counts(text[:15_000])
    assert np.abs(a / a.sum() - b / b.sum()).max() < 1e-3
    assert op10.ngram_counts("12 .") is None


def test_batches_are_bounded_in_bytes(spark):
    from graticule.llm.common import BATCH_BYTES, prepare

    def sizes(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    huge = prepare(spark).range(0, 12, 1, 1).select("id", F.expr("repeat('some words and more ', 400000)").alias("text"))
    got = huge.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in got) == 12 and max(r["bytes"] for r in got) < 3 * int(BATCH_BYTES)
    small = spark.range(0, 1000, 1, 1).select("id", F.lit("a few words").alias("text"))
    assert max(r["rows"] for r in small.mapInArrow(sizes, "rows long, bytes long").collect()) == 200
