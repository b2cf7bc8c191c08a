"""Byte-pair encoding, conversation repair and the Merkle manifest against brute force, with missing, empty, long, tied and repeated rows."""

import hashlib
import itertools
import json
import random
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from graticule.llm import op11_bpe as op11, op12_repair as op12, op13_manifest as op13, queries
from graticule.llm.common import prepare

WORD = queries.vocabulary(queries.WORD_BPE)
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
CLASH = ("ids", "leaf", "tree", "place", "size", "node", "steps", "case", "present", "times", "step", "part", "digest")
ODD = [
    (5, None, None, None), (None, "no id at all here.", "en", "a"), (7, "", "en", "b"), (9, LONG, "en", "a"), (11, "Tie one. Two!", "de", "a"),
    (12, "Tie one. Two!", "de", "a"), (11, "Tie one. Two!", "de", "a"), (13, "mañana 日本語 😀 ß.\n\nSecond\nthird", "es", "b"), (14, " \n\t ", None, None),
    (15, "nul\u0000 and \x1c sep \x85 next <|endoftext|> x", "en", "c"), (None, None, None, None), (1 << 61, "a very large id", "zh", "é"),
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, s, len(t or "") if i != 12 else None) for i, t, lang, s in ODD]
    return prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("x") for c in CLASH})


# --- 11 ---------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(WORD)
    out.no_padding()
    out.no_truncation()
    return out


@pytest.fixture(scope="module")
def words():
    return op11.Vocabulary(WORD)


def test_pair_tree_gives_the_leftmost_of_the_lowest():
    rng = random.Random(3)
    for n in (1, 2, 3, 7, 8, 33):
        ranks = [rng.choice([op11.NONE, 1, 2, 5, 0]) for _ in range(n)]
        tree = op11.PairTree(ranks)
        for _ in range(100):
            low = min(ranks)
            assert tree.lowest() == (-1 if low == op11.NONE else ranks.index(low))
            at = rng.randrange(n)
            ranks[at] = rng.choice([op11.NONE, 1, 2, 5, 0, 9])
            tree.set(at, ranks[at])


def test_merges_equal_a_plain_loop(words):
    rng = random.Random(5)
    for _ in range(200):
        piece = "".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 40)))
        ids = [words.symbols[c] for c in piece[:-1]] + [words.symbols[piece[-1] + "</w>"]]
        while True:
            ranks = [words.pairs.get(p, (op11.NONE,))[0] for p in zip(ids, ids[1:])]
            if not ranks or min(ranks) == op11.NONE:
                break
            at = ranks.index(min(ranks))
            ids[at:at + 2] = [words.pairs[ids[at], ids[at + 1]][1]]
        assert words.merge(piece) == ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r.,'sS12éÉ́ 　\x0bİΣſŉ<|>"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text_equals_the_library(library, words, text):
    ids = words.encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want and words.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_strings_of_special_tokens(library, words):
    for text in ("a<|endoftext|>b", "<|startoftext|><|endoftext|>", "<|<|endoftext|>|>", "<|ENDOFTEXT|>"):
        assert words.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(op11.Vocabulary(WORD, special=False).encode("<|endoftext|>")) < 49406


def test_long_run_of_letters(library, words):
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(20_000))
    assert words.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip_of_tables(docs, odd, library):
    for frame in (docs, odd, docs.limit(0)):
        want = []
        for r in frame.collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            sha = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
            want.append((r["doc_id"], len(ids), sha, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert sorted(map(tuple, op11.round_trip(frame, WORD).collect()), key=repr) == sorted(want, key=repr)
    back = op11.decoded(op11.encoded(odd, WORD), WORD)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [(i, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t, _, _ in ODD], key=repr)


# --- 12 ---------------------------------------------------------------------------------------------------------------


def lightest(kinds, most_inserts=2):
    """All sequences of edits, one after the other."""
    best = (2 * len(kinds), "D" * len(kinds))

    def go(i, inserts, cost, audit, roles):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(kinds) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best, (cost, audit))
        if inserts < most_inserts:
            for r in "ua":
                go(i, inserts + 1, cost + 5, audit + "I", roles + r)
        if i < len(kinds):
            go(i + 1, inserts, cost + 2, audit + "D", roles)
            if kinds[i] != "d":
                extra = 5 * kinds[i].isupper()
                go(i + 1, inserts, cost + extra, audit + "K", roles + kinds[i].lower())
                for r in "ua":
                    go(i + 1, inserts, cost + extra + 1, audit + "R", roles + r)

    go(0, 0, 0, "", "")
    return best


def test_agenda_finds_the_lightest_derivation():
    for n in range(4):
        for kinds in itertools.product("suaoSUAOd", repeat=n):
            assert op12.whole("".join(kinds))[1:] == lightest("".join(kinds))
    rng = random.Random(2)
    for _ in range(60):
        kinds = "".join(rng.choice("suaUAd") for _ in range(7))
        assert op12.whole(kinds)[1:] == lightest(kinds, 1)


def test_stretches_join_to_the_whole():
    rng = random.Random(8)
    for _ in range(200):
        kinds = "".join(rng.choice("suaoUAd") for _ in range(rng.randrange(50)))
        cuts = [0, *sorted(rng.randrange(len(kinds) + 1) for _ in range(5)), len(kinds)]
        solved = op12.Stretches()
        for a, b in zip(cuts, cuts[1:]):
            solved.add(op12.stretch(kinds[a:b]))
        table = solved.table()
        assert min(table[0, q] for q in op12.ENDS if (0, q) in table) == op12.whole(kinds)[1:]


def repaired(rows):
    """(conv_id, turn, role, text) rows, one conversation after the other."""
    conversations = {}
    for conv_id, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        case = zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
        role, text, kept = name(role), name(text), conversations.setdefault(conv_id, [])
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        kept += [] if case == 0 else [(turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    for conv_id, kept in conversations.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        kinds, counts, seen = "", [0, 0, 0], set()
        for _, role, text in kept:
            end = text.strip(" \t\n\x0b\x0c\r")[-1:]
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            kinds += "d" if fault in (0, 1) else letter.upper() if fault == 2 else letter
        turns = {t for t, _, _ in kept if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        _, cost, audit = op12.whole(kinds)
        out, rest = [], iter(kept)
        for letter in audit:
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
            if letter == "I":
                out.append((role, ""))
                continue
            _, own, text = next(rest)
            if letter != "D":
                out.append((own if letter == "K" else role, text))
        assert next(rest, None) is None and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        yield (conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, digest)


def odd_conversations():
    texts = ["Hi.", "ok", "", " ", None, "Ends here! \n", LONG]
    for i in range(3000):
        # One conversation holds most rows, and one row of it is repeated very often.
        conv = None if i % 17 == 0 else 7 if i % 3 else i % 5 if i % 2 else 1 << 60
        yield (conv, None if i % 11 == 0 else (i * 7) % 400, [None, "user", "assistant", "system", "", "tool"][i % 6],
               texts[i % 7] if i % 70 else f"Yes! {i % 60}.")
        if i % 3 == 0:
            yield 7, 12, "user", "the same"


def test_repairs_of_tables(spark, sf_dir):
    tables = [
        ([tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()], 1 << 16),
        (list(odd_conversations()), 100), (list(odd_conversations()), 1 << 16), ([], 10),
        ([(1, t, "user", "Same.") for t in range(40)] + [(2, 0, "user", "Hi.")] * 30 + [(3, None, None, None)], 5),
    ]
    for rows, per_partition in tables:
        frame = prepare(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in CLASH}).repartition(3)
        got = sorted(map(tuple, op12.repaired(op12.damaged(frame), per_partition).collect()), key=repr)
        assert got == sorted(repaired(rows), key=repr)


# --- 13 ---------------------------------------------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_of(nodes, fanout):
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, p in zip(paths, places):
            run = p - p % fanout
            path.append((nodes[run:p], nodes[p + 1:run + fanout]))
        nodes, places = [H(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)], [p // fanout for p in places]
    return nodes[0], paths


def manifest(rows, fanout):
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r, n: H(*map(field, (r["doc_id"], r["source"], r["lang"], n, r["text"])))
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["n_chars"]), r["n_chars"], r["text"], r))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees.append(tree_of([x[2] for x in groups[name]], fanout))
    if not rows:
        return
    root, last = tree_of([t for t, _ in trees], fanout)
    for name, (subroot, paths), above in zip(names, trees, last):
        for (_, _, own, n, _, r), path in zip(groups[name], paths):
            forged = r["doc_id"] is not None and n is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf(r, n + 1) if forged else own
            for left, right in (full := path + above):
                node = H(*left, node, *right)
            yield r["doc_id"], own, subroot, root, H(*[h for a, b in full for h in a + b]), node, node == root


@pytest.mark.parametrize("fanout, height, per_partition", [(2, 10, 1 << 17), (2, 2, 30), (3, 1, 50), (2, 0, 1000)])
def test_manifests_of_tables(docs, odd, fanout, height, per_partition):
    for frame in (docs, odd) if height else (docs.limit(40),):
        want = sorted(manifest([r.asDict() for r in frame.collect()], fanout), key=repr)
        forged = F.crc32(frame["doc_id"].cast("string").cast("binary")) % 7 == 0
        got = sorted(map(tuple, op13.manifest(frame, forged, fanout, height, per_partition).collect()), key=repr)
        assert got == want and {r[-1] for r in got} == {True, False}


def test_manifest_of_nothing_and_of_one(docs):
    assert op13.manifest(docs.limit(0)).collect() == []
    row = op13.manifest(docs.where("doc_id = 0")).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["proof_sha256"] == H()


def test_vocabulary_is_read_as_it_is(words):
    with open(WORD, encoding="utf-8") as f:
        file = json.load(f)
    assert len(words.pairs) == len(file["model"]["merges"]) and len(words.tokens) == 49408
