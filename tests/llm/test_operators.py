"""Training-data operators on small frames with nulls, empty texts, repeats, clashing columns, and empty tables."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablespoon.llm import (
    decontaminate, grammar, licenses, line_rules, mixing, near_dup, pii, quality_rank, queries, secret_scan, spans, token_store, url_filter,
)

from tablespoon.llm.words import ALNUM, hashed_words, text_bytes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t", "x", "the same text twice", "the same text twice", "é ß 字 \u2028", "a" * 300_000]


def frame(spark, texts, **columns):
    rows = [(i, t, *(c[i] for c in columns.values())) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {c} string" for c in columns))


def lower(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


# --- near copies -------------------------------------------------------------------------------------------------


def plain_components(texts, n, percent):
    sets = []
    for t in texts:
        w = WORDS.findall(lower(t))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def copies(seed, groups=6, each=9, length=60):
    import random

    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for _ in range(each):
            changed = list(base)
            for _ in range(rng.randrange(8)):
                changed[rng.randrange(length)] = f"n{rng.randrange(10_000)}"
            texts.append(" ".join(changed))
    return texts + ODD


@pytest.mark.parametrize("n", [2, 5])
def test_components_equal_plain_pairs(spark, n):
    texts = copies(n)
    found = {r.doc_id: r for r in near_dup.near_copies(frame(spark, texts), words=n).collect()}
    assert [(found[i].n_shingles, found[i].component_id) for i in range(len(texts))] == plain_components(texts, n, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


def test_rows_that_share_an_id_are_one_document(spark):
    x, y = (" ".join(f"{c}{i}" for i in range(80)) for c in "xy")
    rows = [(1, x), (1, y), (2, f"{y} q"), (3, f"{x} q"), (4, "z"), (4, None), (0, x)]
    found = near_dup.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(0, 0), (1, 0), (1, 0), (2, 0), (3, 0), (4, 4), (4, 4)]


def test_digests_do_not_depend_on_the_place_in_a_block():
    value = np.arange(1, 7, dtype=np.uint64)
    whole = near_dup._digests(value, np.array([0, 3, 3, 6, 6]))
    assert whole[0] == near_dup._digests(value[:3], np.array([0, 3]))[0] and whole[2] == near_dup._digests(value[3:], np.array([0, 3]))[0]


def test_one_of_each_keeps_all_columns_and_odd_keys(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (None, "a b c d e f", "z"), (3, None, None), (4, "", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles string")
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.n_shingles) for r in kept.collect()) == [(0, "z"), (1, "x"), (3, None), (4, "q")]
    assert near_dup.one_of_each(docs.limit(0)).count() == 0


# --- decontamination ---------------------------------------------------------------------------------------------


def plain_hits(texts, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wanted = {}
    for name, t in items:
        w = word.findall(lower(t))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wanted.setdefault(tuple(w[i : i + window]), set()).add(name)
    out = []
    for t in texts:
        w, hit, names = word.findall(lower(t)), set(), set()
        for key, who in wanted.items():
            for i in range(len(w) - len(key) + 1):
                if tuple(w[i : i + len(key)]) == key:
                    hit |= set(range(i, i + len(key)))
                    names |= who
        out.append((len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_matches_equal_plain_windows(spark, block):
    texts = ["b a b a b a", "x A-b.a y a b", "a a a a a a a", "q one two r", None, "", "b a b a b a"]
    items = [("1", "a b a b"), ("2", "a a a a a"), ("3", "one two"), ("3", "x a b"), ("4", None), ("5", "!!")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.verbatim_matches(
        frame(spark, texts), benchmark, keep=["doc_id"], window=3, test_block_bytes=block
    ).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in found] == plain_hits(texts, items, 3)
    assert [m.length for m in found[0].matches if m.item == "1"] == [4, 4] or max(m.length for m in found[0].matches) == 4


def test_repetitive_texts_cost_no_more_than_their_length(spark):
    tests = decontaminate.test_set(["x"], ["a " * 2000])
    data, bounds = text_bytes(pa.array(["a " * 50_000], pa.string()))
    words = hashed_words(data, bounds, ALNUM)
    tracemalloc.start()
    hit, longest, pairs, matches = decontaminate.search_shard(words.hashes, words.rows, tests, 13)
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()
    assert (hit.tolist(), longest.tolist(), pairs.tolist()) == ([50_000], [2000], [[0, 0]])
    assert len(matches) == 48_001 and matches[:, 3].max() == 2000


@pytest.mark.parametrize("seed", range(40))
def test_longest_matches_equal_plain_search(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abc" if seed % 2 else "abcdefg") for _ in range(rng.randrange(n)))
    texts, items, window = [text(14) for _ in range(6)], [(str(i % 4), text(9)) for i in range(5)], rng.choice([2, 3, 5])
    tests = decontaminate.test_set(*zip(*items))
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    words = hashed_words(data, bounds, ALNUM)
    hit, longest, pairs, matches = decontaminate.search_shard(words.hashes, words.rows, tests, window)
    for i, (t, (_, n_hit, names)) in enumerate(zip(texts, plain_hits(texts, items, window))):
        runs = [" ".join(t.split()[a:b]) for a in range(len(t.split())) for b in range(a + 1, len(t.split()) + 1)]
        best = max((len(r.split()) for r in runs if any(f" {r} " in f" {body} " for _, body in items)), default=0)
        assert (hit[i], longest[i], sorted(tests.names[x] for x in pairs[pairs[:, 0] == i, 1])) == (n_hit, best, names)
        covered = {p for _, _, a, n in matches[matches[:, 0] == i].tolist() for p in range(a, a + n)}
        assert len(covered) == n_hit


def test_clean_documents_keep_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 5), (2, "z y x w v u", 6), (None, None, None)], "doc_id long, text string, n_hit int")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted(str(r.n_hit) for r in kept.collect()) == ["6", "None"]
    assert decontaminate.clean_documents(docs, items.limit(0)).count() == 3
    assert decontaminate.clean_documents(docs.limit(0), items).count() == 0


# --- token files -------------------------------------------------------------------------------------------------


def test_token_files_hold_what_the_library_encodes(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = [*ODD[:-1], "It's ok, isn't it? <|endoftext|> A.B|C İ K ﬁ 'S", "Ünï cödé ЖЖ. x!y 1.5\u00a0z", "e\u0301 E\u0301 h\u0331 H\u0331"]
    docs = frame(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") > 0, 100 - F.col("doc_id")))
    path = str(tmp_path / "tokens")
    token_store.write_tokens(docs, path, queries.vocabulary(), shard_tokens=16)
    found = token_store.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    encoder = Tokenizer.from_file(queries.vocabulary())
    ordered = sorted(docs.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id)
    start = 0
    for row, made in zip(ordered, found, strict=True):
        ids = [*encoder.encode(row.text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert (made.doc_id, made.start, made.n_tokens, made.ids_crc32, made.ids) == (row.doc_id, start, len(ids), crc, ids)
        start += len(ids)
    for some in (found[0], found[3], max(found, key=lambda r: r.n_tokens)):
        assert some.ids in token_store.read_document(spark, path, some.doc_id)
        assert some.ids[2:5] in token_store.read_document(spark, path, some.doc_id, 2, 5)
    assert token_store.read_document(spark, path, -5) == []


def test_ranges_of_documents_expand_as_a_whole_decode(spark):
    rng = np.random.default_rng(1)
    phrases = [rng.integers(0, 50, 8) for _ in range(10)]
    docs = [np.concatenate([*(phrases[i] for i in rng.integers(0, 10, rng.integers(0, 60))), [2]]) for _ in range(100)]
    made = grammar.compress(np.concatenate(docs).astype(np.uint32), np.cumsum([len(d) for d in docs]), 60)
    assert len(made.left) > 100
    for i, d in enumerate(docs):
        for first, end in ((0, None), (3, 9), (len(d) - 1, None), (5, 5), (0, 10**9)):
            assert grammar.decode_range(made, i, first, end).tolist() == d[first:end].tolist()


def test_no_documents_make_no_tokens(spark, tmp_path):
    path = str(tmp_path / "none")
    token_store.write_tokens(frame(spark, ["a"]).limit(0), path, queries.vocabulary())
    assert token_store.read_tokens(spark, path).count() == 0


# --- mixing ------------------------------------------------------------------------------------------------------


def mix_frame(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), None if i % 11 == 0 else f"s{i % 5}") for i in range(600)]
    rows += [(None, None, "s1"), (1000, "", "s2"), (1001, "w", "tiny"), (1001, "w", "tiny")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = mix_frame(spark)
    rows = mixing.mix(docs).join(docs.select("doc_id", "source").distinct(), "doc_id").collect()
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    names = [*sorted(s for s in size if s), None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    goal, left, open_ = {}, 1.5 * sum(size.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not full:
            break
        goal |= {s: 2.0 * size[s] for s in full}
        left -= sum(goal[s] for s in full)
        open_ -= full
    goal |= {s: level * weight[s] for s in open_}
    for s in names:
        assert abs(target[s] - goal[s]) < 1e-6 * goal[s] + 1e-9
        assert abs(taken[s] - goal[s]) <= max(25, 0.02 * goal[s])
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter(map(str, again)) == Counter(map(str, mixing.mix(docs).collect()))


def test_mixed_documents_are_whole_rows(spark):
    docs = mix_frame(spark).withColumn("size", F.lit("mine"))
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    words = kept.select(F.sum(mixing.word_count("text"))).first()[0]
    assert words == mixing.mix(docs).agg(F.sum("taken")).first()[0]
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0


def test_repeated_rows_are_taken_one_by_one(spark, tmp_path):
    rows = [(i, "w " * (5 + i % 7), "a") for i in range(600)] + [(i, "v " * (8 + i % 5), "b") for i in range(700)]
    docs = spark.createDataFrame(rows + [(7, "x " * 10, "c")] * 900, "doc_id long, text string, source string").repartition(6)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    found = {r.target: r.taken for r in mixing.mix(docs).groupBy("target").agg(F.sum("taken").alias("taken")).collect()}
    assert len(found) == 3 and all(abs(taken - target) <= 10 for target, taken in found.items())
    assert mixing.mixed_documents(docs).select(F.sum(mixing.word_count("text"))).first()[0] == sum(found.values())


def test_dual_equals_a_plain_bisection(spark):
    cells = spark.createDataFrame([("a", s, n) for s, n in ((1, 500), (9, 40), (130, 7), (4000, 1))], "source string, size long, n long")
    targets = spark.createDataFrame([("a", 5200.0)], "source string, target double")
    solved = mixing.balanced_rates(cells, targets).first()
    rows = [(r["size"], r.n) for r in cells.collect()]
    taken = lambda a: sum(n * s * min(2.0, math.exp(a * s / solved.mean)) for s, n in rows)
    low, high = -1000.0, 1000.0
    for _ in range(200):
        low, high = ((low + high) / 2, high) if taken((low + high) / 2) < 5200 else (low, (low + high) / 2)
    assert abs(solved.a - low) < 1e-6 and abs(taken(solved.a) - 5200) < 0.1


def test_sources_without_words_take_nothing(spark):
    empty = spark.createDataFrame([(2000, "", "blank"), (2001, None, "blank"), (2002, " \n", "blank")], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mixing.mix(mix_frame(spark).union(empty)).collect()}
    assert [(rows[i].source_size, rows[i].target, rows[i].taken) for i in (2000, 2001, 2002)] == [(0, 0.0, 0)] * 3
    assert sum(r.taken for r in rows.values()) > 0
    nothing = empty.union(spark.createDataFrame([(2003, "", None)], empty.schema))
    assert [(r["size"], r.target, r.taken) for r in mixing.mix(nothing).collect()] == [(0, 0.0, 0)] * 4
    assert mixing.mixed_documents(nothing).count() == 4


# --- line rules --------------------------------------------------------------------------------------------------


def test_line_rules(spark):
    good = "This line has quite enough plain words to stay in the text."
    more = "Another sentence follows here, with different words and a proper end mark."
    menu, shout, nav = "a | b | c | d | e", "BUY NOW AND SAVE MONEY TODAY", "Home"
    texts = [*ODD, "\n".join([good, more, menu, nav]), "\n".join([good, shout + " 1", more, " ".join(f"WORD{i}" for i in range(60))]), good]
    docs = frame(spark, texts, n_words=["mine"] * len(texts))
    found = {r.doc_id: r.rules for r in line_rules.judge_lines(docs).collect()}
    assert found[8].clean_text == good + "\n" + more and found[8].kept and found[8].n_bad_lines == 2
    assert not found[9].kept and not found[9].base_failed
    assert found[10].base_failed and found[0].n_words == 0 and found[0].clean_text == ""
    kept = line_rules.kept_documents(docs)
    assert kept.columns == docs.columns and [(r.doc_id, r.n_words) for r in kept.collect()] == [(8, "mine")]
    assert line_rules.kept_documents(docs.limit(0)).count() == 0


def test_lines_of_other_scripts_end_with_their_marks(spark):
    ends = ["这是一个完整的句子。", "本当ですか？", "とても良い！", "यह एक वाक्य है।", "هل هذا صحيح؟", "这一行没有标点但是并不是很短的一行"]
    texts = ["\n".join(ends * 5), "菜单\n" + "\n".join(["这是一个完整的句子。"] * 3)]
    found = {r.doc_id: r.rules for r in line_rules.judge_lines(frame(spark, texts)).collect()}
    assert found[0].n_bad_lines == 0 and found[0].clean_text == texts[0]
    assert found[1].n_bad_lines == 1 and "菜单" not in found[1].clean_text


# --- personal data and secrets -----------------------------------------------------------------------------------


def plain_personal(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m.group().split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or pii.luhn(digits)):
                out.append((kind, *m.span()))
    return out


PERSONAL = [
    "a@b.c@d.e a@b@c.d @x.y", "1.2.3.4.5.6.7.8 300.1.1.1 00001.2.3.0255", "+1 (234) 555-1234+49 123 4111 1111 1111 1111",
    "4111-1111-1111-1111 x@y.z_w@a.bc", "é@b.cc é a@b.cc", "9" * 5000, "a" * 50_000 + "@", *ODD,
]


def test_base_spans_are_those_of_the_patterns(spark):
    found = {r.doc_id: r for r in pii.find_personal_data(frame(spark, PERSONAL)).collect()}
    for i, text in enumerate(PERSONAL):
        wanted = plain_personal(text or "")
        assert pii.base_spans(text or "") == wanted
        assert found[i].base_sha256 == hashlib.sha256(spans.listed(wanted).encode()).hexdigest()
        assert found[i].spans.startswith(spans.listed(wanted))
        assert [found[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in wanted) for k in pii.KINDS]


def test_contexts_of_seeds_discover_new_identifiers(spark):
    texts = [f"some words and call me at +1 (555) 123-{1000 + i} then more" for i in range(30)]
    texts += ["please call me at 5551234 now", "other words then 777888 more"]
    found = {r.doc_id: r for r in pii.find_personal_data(frame(spark, texts)).collect()}
    assert found[30].spans == "context:18:25" and found[31].spans == "" and found[0].n_context == 0
    assert pii.find_personal_data(frame(spark, texts).limit(0)).count() == 0


def test_contexts_are_places_and_spread(spark):
    texts = [f"some words and call me at +1 (555) 123-{1000 + i} then more" for i in range(40)]
    texts += ["please call me at 5 or so"] + [f"clean text number {i} has a 5 in it" for i in range(30)]
    at = len(texts)
    texts += ["please call me at (017) 555-7713 now", "please call me at John Smith now", "and then call me at jane_roe now", "see 8812345 and 8812345"]
    # a second cue that no seed follows: its values are known from the first one
    texts += [f"so call me at 777000{i} today" for i in range(6)] + [f"or text my pager {'777000' + str(i)} today" for i in range(6)]
    texts += ["or text my pager 9990001 today", "pages 9990002 today"]
    found = pii.find_personal_data(frame(spark, texts)).orderBy("doc_id").collect()
    marked = lambda i: [texts[i][int(a) : int(b)] for k, a, b in (x.split(":") for x in found[i].spans.split(",") if x) if k == "context"]
    assert all(marked(i) == [] for i in range(40, at))
    assert [marked(i) for i in range(at, at + 4)] == [["(017) 555-7713"], ["John Smith"], ["jane_roe"], []]
    assert all(f.n_context == len(marked(i)) for i, f in enumerate(found))


def test_believed_instances_admit_patterns(spark):
    texts = [" ".join(f"call me at +1 (555) {100 + i}-{1000 + j} then" for j in range(50)) for i in range(160)]
    texts += [f"call me at 77700{i} then " * 30 for i in range(10, 50)] + [f"or text my pager 77700{i} today" for i in range(10, 50)]
    texts += ["or text my pager 9990001 today"]  # no seed stands behind this cue
    found = pii.find_personal_data(frame(spark, texts)).orderBy("doc_id").collect()
    assert found[-1].spans == found[-2].spans == "context:17:24"


def github(body):
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        out = secret_scan._BASE62[rest] + out
    return f"ghp_{body}{out}"


def test_secrets(spark):
    token = github("0123456789abcdefghijABCDEFGHIJ")
    texts = [
        "password=abc password: 'xyz123' tokentoken==abcdefg secret\"='a", "AKIAAKIA" + "B" * 20, "PassWord = abcdef0123456789abcdef01",
        "api_key=apikey=123456token:token:abcdefgh ſecret=abcdefgh", f"é {token} {token[:-1]}x", *ODD,
    ]
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = {r.doc_id: r for r in secret_scan.find_secrets(frame(spark, texts)).collect()}
    for i, text in enumerate(t or "" for t in texts):
        wanted = [("assign", *m.span()) for m in assign.finditer(text) if len(m.group(2)) >= 6 and "ſ" not in m.group(1)]
        wanted += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
        wanted += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
        wanted.sort(key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))
        assert found[i].base_sha256 == hashlib.sha256(spans.listed(wanted).encode()).hexdigest(), text
    assert found[4].n_checked == 1 and f"github:2:{2 + len(token)}" in found[4].spans
    assert secret_scan.base58_matches(
        "xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"
    )
    assert secret_scan.find_secrets(frame(spark, texts).limit(0)).count() == 0


# --- quality -----------------------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    good = [f"The {i} quick brown fox, which was late, jumps over the lazy dog number {i * 7}. It then rests." for i in range(120)]
    bad = [f"### {i} *** buy %%% now $$$ {i} ### now now now now now" for i in range(60)]
    docs = frame(spark, [*good, *bad, *ODD[:3]])
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(180)] + [(181, None)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in quality_rank.rank_quality(docs, labels).collect()}
    held = [i for i in range(180) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert [i for i in range(180) if rows[i].held_out] == held
    assert sum(rows[i].predicted == int(i < 120) for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    assert {r.score for r in quality_rank.rank_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_a_repeated_key_enters_the_sample_once(spark, monkeypatch):
    seen = []
    pairs = quality_rank._pairs
    monkeypatch.setattr(quality_rank, "_pairs", lambda few, partners: seen.extend(few.collect()) or pairs(few, partners))
    good = [f"The {i} quick brown fox, which was late, jumps over the lazy dog number {i * 7}. It then rests." for i in range(60)]
    bad = [f"### {i} *** buy %%% now $$$ {i} ### now now now now now" for i in range(60)]
    key = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)
    docs = frame(spark, [*good, *bad]).union(spark.createDataFrame([(key, good[key])] * 400, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    assert quality_rank.rank_quality(docs, labels, sample=30).count() == 520
    taken = Counter(r.doc for r in seen if r.label == 1)
    assert max(taken.values()) == 1 and len(taken) >= 15


# --- licences ----------------------------------------------------------------------------------------------------


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("a/LICENSE", mit), ("a/b/LICENSE", gpl), ("a/x", "text"), ("a/b/c/y", "text"), ("a/b/z", "words " * 30 + "\n" + mit),
        ("q/w", None), ("a/v", "license and registration please"), (None, mit), ("q/u", ""), ("a/x", "text again"),
    ]
    files = spark.createDataFrame(rows, "path string, text string")
    found = {}
    for r in licenses.scan_licences(files).collect():
        found.setdefault(r.path, []).append((r.licence, r.origin, r.source_path))
    assert found["a/x"] == [("mit", "inherited", "a/LICENSE")] * 2
    assert found["a/b/c/y"] == [("gpl-3.0", "inherited", "a/b/LICENSE")]
    assert found["a/b/z"] == [("mit", "own", "a/b/z")] and found["a/LICENSE"] == [("mit", "own", "a/LICENSE")]
    assert found["a/v"] == [("mit", "inherited", "a/LICENSE")]
    assert found["q/w"] == found["q/u"] == found[None] == [(None, "none", None)]
    assert licenses.scan_licences(files.limit(0)).count() == 0


def test_full_texts_long_lines_and_distinguishing_terms(spark):
    from importlib.resources import files as package_files

    full = lambda n: (package_files("tablespoon.llm") / "licence_texts" / f"{n}.txt").read_text()
    fill = "plain words of a paragraph that goes on and on before and after what it says about terms of use"
    wanted = {f"{n}/LICENSE": (n, full(n)) for _, n, _, _ in licenses.TEXTS}
    wanted |= {
        "h/a": ("gpl-3.0", f"{fill} this work is licensed under the GNU General Public License, version 3. {fill}"),
        "h/b": ("gpl-3.0", f"# {fill}\n# Licensed under the GNU General\n# Public License version 3\n{fill}"),
        "h/c": ("mit", f"// SPDX-License-Identifier: MIT\n{fill}"),
        "h/d": ("gpl-2.0", f"{fill}\nThis work is licensed under the GNU General Public License, version 2.\n{fill}"),
        "h/e": ("lgpl-3.0", f"This work is licensed under the GNU Lesser General Public License, version 3.\n{fill}"),
        "h/f": ("cc-by-sa-4.0", f"Licensed under CC BY-SA 4.0.\n{fill}"),
        "h/g": ("cc-by-nc-nd-4.0", f"Licensed under CC BY-NC-ND 4.0.\n{fill}"),
        "h/i": (None, f"Licensed under the GNU General Public License, version 7.\n{fill}"),
    }
    rows = [(p, t) for p, (_, t) in wanted.items()] + [("mit/src/x", "nothing here"), ("gpl-2.0/y", "nothing here")]
    found = {r.path: r for r in licenses.scan_licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {p: found[p].licence for p in wanted} == {p: n for p, (n, _) in wanted.items()}
    assert (found["mit/src/x"].licence, found["mit/src/x"].source_path) == ("mit", "mit/LICENSE")
    assert (found["gpl-2.0/y"].licence, found["gpl-2.0/y"].origin) == ("gpl-2.0", "inherited")


# --- urls --------------------------------------------------------------------------------------------------------


URLS = [
    None, "", "no scheme/org/", "http://X.ORG/", "https://a.example.org/es/1", "https://example.org/en/12?x=/es/", "http://example.org",
    "http://myexample.org/en/1", "http://b.com/de/1#/fr/", "http://b.com/fr/", "http://casino-win.example.net/", "x://org/", "http:///fr/",
    "http://b.com?/fr/", "http://b.com/fr/", "http://a.b.com/é/://",
]


def test_urls_by_array_and_by_join(spark):
    entries = [url_filter.Entry(*x) for x in queries.URL_RULES] + [url_filter.Entry(f"{h}/", "block", False) for h in queries.BLOCKED_HOSTS]
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    wanted = []
    for i, url in enumerate(URLS):
        rest = (url or "").partition("://")[2]
        rest = re.match(r"[^?#]*", rest).group()
        host, path = lower(re.match("[^/]*", rest).group()), rest[len(re.match("[^/]*", rest).group()) :]
        fits = []
        for e in entries:
            h, _, p = e.text.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((e.rule, len(e.text), e.text, e.verdict))
        best = max(fits, default=None)
        wanted.append((i, host, path, best[2] if best and best[0] else None, best[3] if best else "allow", best[2] if best else None))
    assert sorted(map(tuple, url_filter.filter_urls(pages, entries).collect())) == wanted
    assert sorted(map(tuple, url_filter.filter_urls(pages, entries, list_bytes=0).collect())) == wanted
    assert url_filter.filter_urls(pages.limit(0), entries).count() == 0


def test_long_hosts_are_probed_at_their_end(spark):
    urls = ["http://" + "a." * 32_768 + "spam.example.com/x", "http://xspam.example.com/", "http://" + "b" * 70_000 + "/x", "http://.spam.example.com/"]
    pages = spark.createDataFrame(list(enumerate([*urls, urls[0]])), "page_id long, url string")
    entries = [url_filter.Entry("spam.example.com/", "block", rule=False)]
    listed = spark.createDataFrame([("spam.example.com",)], "host string")
    for found in (url_filter.filter_urls(pages, entries), url_filter.joined_urls(pages, entries), url_filter.filter_urls(pages, [], blocked=listed)):
        assert [r.verdict for r in found.orderBy("page_id").collect()] == ["block", "allow", "allow", "block", "block"]
    assert len(list(url_filter._probes("a." * 32_768 + "spam.example.com", "/", [1], 16))) == 3


def test_names_are_blocked_under_every_domain(spark, tmp_path):
    hosts = ["m.casino-win.example.com", "adult-x.example.edu", "a.b.free-bets.co.uk", "spam-farm.example.info"]
    clean = ["mycasino-win.example.com", "casino-win", "example.com"]
    rows = [(i, f"http://{h}/zz?x") for i, h in enumerate([*hosts, *clean])] + [(90, None), (91, "http://casino-win.example.com/de/1")]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: r for r in queries.url_verdicts(spark, str(tmp_path)).collect()}
    assert [found[i].verdict for i in range(len(rows) - 2)] == ["block"] * 4 + ["allow"] * 3 and found[90].verdict == "allow"
    assert [found[i].entry for i in range(3)] == ["casino-win.example.com/", "adult-x.example.edu/", "free-bets.co.uk/"]
    assert found[91].rule == "com/de/"  # rules go first


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda text: len(text))
    path = tmp_path / "list.bin"
    path.write_bytes(url_filter.packed([url_filter.Entry("a.b/", "allow"), url_filter.Entry("c.d/", "block"), url_filter.Entry("e/", "block")]))
    listed = url_filter.DigestArray(str(path))
    found = listed.find(["c.d/", "x.y/", "a.b/", "e/", "longer/"])
    assert [listed.strings[listed.ends[i] : listed.ends[i + 1]].tobytes().decode() if i >= 0 else None for i in found] == ["c.d/", None, "a.b/", "e/", None]
