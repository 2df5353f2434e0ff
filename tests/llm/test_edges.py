"""Nulls, empty and very long texts, repeats, empty tables and clashing columns, against brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tableloom.llm import (
    byte_bpe, components, decontaminate, language_id, quality_classifier, quality_rules, sharding, simhash, token_files, url_filter, warc,
)
from tableloom.llm.common import word_blocks
from tableloom.llm.queries import BYTE_RANKS, RULES, WORD_TOKENIZER
from tests.llm.conftest import EDGE_TEXTS
from tests.llm.test_queries import brute_components, brute_fingerprint

RANKS, PATTERN = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN


def library():
    """The reference encoder of the same ranks."""
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated),
    )


def test_word_blocks_cut_only_at_white_space():
    data = b"ab  cde\tf" * 50
    for size in (1, 3, 7, 1000):
        assert [w for block in word_blocks(data, size) for w in block] == data.split()


def test_quality_rules_edges(spark, edge_docs, no_docs):
    wanted = sorted(((i, *brute_measures(t)) for i, t in EDGE_TEXTS), key=repr)
    assert rows_of(quality_rules.judge(edge_docs), "doc_id", *quality_rules.MEASURES) == wanted
    assert quality_rules.judge(no_docs).count() == 0


def test_windows_of_one_hash_are_told_apart(spark, edge_docs, monkeypatch):
    """With a hash of three values nearly all windows collide, and the words decide."""
    monkeypatch.setattr(quality_rules, "window_hash", lambda *words: F.pmod(F.xxhash64(*words), F.lit(3).cast("long")))
    small = edge_docs.where("doc_id is null or doc_id <> 9")
    wanted = sorted(((i, *brute_measures(t)) for i, t in EDGE_TEXTS if i != 9), key=repr)
    assert rows_of(quality_rules.judge(small), "doc_id", *quality_rules.MEASURES) == wanted


def test_bad_host_loses_its_documents_but_small_hosts_are_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "too short", "bad") for i in range(40)] + [(100, good, "bad"), (200, "too short", "tiny"), (201, good, "tiny")]
    rows += [(300 + i, good, f"host{i % 20}") for i in range(400)] + [(900, good, None)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    assert not kept[100] and kept[201] and kept[900] and not kept[200] and all(kept[300 + i] for i in range(400))


def test_byte_bpe_edges(spark, edge_docs, no_docs):
    plain = library()
    tokens = byte_bpe.encode(edge_docs, RANKS, PATTERN)
    found = rows_of(byte_bpe.decode(tokens, RANKS, PATTERN), "doc_id", "n_tokens", "ids", "decoded")
    wanted = []
    for i, t in EDGE_TEXTS:
        ids = np.array(plain.encode_ordinary(t or ""), "<u4")
        wanted.append((i, len(ids), bytearray(ids.tobytes()), bytearray((t or "").encode())))
    assert found == sorted(wanted, key=repr)
    assert byte_bpe.decode(byte_bpe.encode(no_docs, RANKS, PATTERN), RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("leaf", [1, 2, 3, 8])
def test_joined_halves_are_the_whole(leaf):
    draw, coder, plain = random.Random(leaf), byte_bpe.coder(RANKS, PATTERN), library()
    pieces = ["a", "B", " ", "  ", "\n", "'s", "'", "'re", "12", "é", "...", "　", "\x1c", "the ", "日本", "\u0301"]
    for _ in range(300):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 50)))
        ids = coder.encode(text, leaf)
        assert ids.tolist() == plain.encode_ordinary(text)
        assert coder.decode(ids.tolist(), leaf) == text.encode()


def test_another_pattern_is_refused():
    with pytest.raises(ValueError, match="proven"):
        byte_bpe.ByteBpe(RANKS, r"\S+|\s+")


def test_merges_of_one_match_are_the_librarys():
    draw, coder, plain = random.Random(12), byte_bpe.coder(RANKS, PATTERN), library()
    for size in [1, 2, 3, 5, 9, 30, 200, 3_000]:
        for letters in ("ab", "etaoinshrdlu", "éèа日本x"):
            for _ in range(20 if size < 1_000 else 2):
                word = "".join(draw.choice(letters) for _ in range(size))
                assert [i for m in coder.matches(word) for i in coder.merge(m)] == plain.encode_ordinary(word)


def test_very_long_runs_are_encoded(spark):
    coder = byte_bpe.coder(RANKS, PATTERN)
    assert coder.decode(coder.encode(" " * 1_200_000 + "x").tolist()) == b" " * 1_200_000 + b"x"


def test_warc_edges(spark):
    rows = [
        (1, "http://a/", "same"), (2, None, "same"), (9, "http://b/\r\nx", "same"), (3, "u", None), (4, "u", ""), (5, "u", "own\r\n\r\nWARC/1.1"),
        (9, "http://b/", "same"), (None, "u", "same"), (None, "u", "lonely"), (None, "v", "lonely"),
    ]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, offset int")
    found = rows_of(warc.archived_pages(pages), "page_id", "payload_bytes", "record_type", "refers_to", "payload_digest")
    first = {"same": 9, "": 4, "own\r\n\r\nWARC/1.1": 5, "lonely": None}
    wanted = []
    for page, _, html in rows:
        body = html or ""
        revisit = first[body] is not None and page != first[body]
        wanted.append((page, len(body), "revisit" if revisit else "response", first[body] if revisit else None, warc.payload_digest(body.encode())))
    assert found == sorted(wanted, key=repr)
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_selected_records_are_read_by_coalesced_ranges(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 50) for i in range(200)], "page_id int, url string, html string")
    index = warc.write_archives(pages.coalesce(1), str(tmp_path / "w"))
    chosen = index.where(F.col("url").rlike("[05]$"))
    assert sorted(int(r["page"]) for r in warc.read_records(chosen, str(tmp_path / "w")).collect()) == list(range(0, 200, 5))
    reads = list(warc.ranges([("a", 0, 10), ("a", 10, 10), ("a", 10**9, 5), ("b", 0, 5)]))
    assert [r[:3] for r in reads] == [("a", 0, 20), ("a", 10**9, 10**9 + 5), ("b", 0, 5)]


def test_language_id_edges(spark, edge_docs, no_docs):
    profiles = language_id.fit(edge_docs)
    found = language_id.predict(edge_docs, profiles).collect()
    assert len(found) == len(EDGE_TEXTS)
    for r in found:
        text = dict((i, t) for i, t in EDGE_TEXTS)[r["doc_id"]]
        assert r["lang_pred"] == ("en" if text and re.search(r"[^\W\d_]", text) else "und")
    empty = language_id.fit(no_docs)
    assert language_id.predict(edge_docs, empty).where("lang_pred != 'und' or score != 0 or not rejected").count() == 0
    assert language_id.keep_identified(edge_docs, empty).count() == 0
    assert language_id.keep_identified(edge_docs, profiles).columns == edge_docs.columns
    assert language_id.predict(no_docs, profiles).count() == 0


def test_narrow_margins_are_rejected(spark):
    rows = [("aa", "kala maja puu " * 40), ("bb", "schnell durch wald " * 40)] * 3
    docs = spark.createDataFrame([(i, l, t) for i, (l, t) in enumerate(rows)] + [(99, None, "zzzz qqqq")], "doc_id int, lang string, text string")
    found = {r["doc_id"]: r for r in language_id.predict(docs, language_id.fit(docs)).collect()}
    assert found[0]["lang_pred"] == "aa" and found[1]["lang_pred"] == "bb" and not found[0]["rejected"]
    assert found[99]["rejected"] and found[99]["lang_pred"] in ("aa", "bb")


@pytest.mark.parametrize("candidates", [language_id.CANDIDATES, 1])
def test_copies_do_not_thin_out_the_training_texts(spark, monkeypatch, candidates):
    monkeypatch.setattr(language_id, "CANDIDATES", candidates)
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(12)) for _ in range(300)]
    rows = [("aa", texts[0])] * 9_000 + [("aa", t) for t in texts] + [("bb", "schnell durch wald " * 5)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    held = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    known = language_id.predict(held, language_id.fit(docs)).where("lang_pred = 'aa' and score > 0.4").count()
    assert known == language_id.SAMPLE_TEXTS


def test_every_language_is_learned_in_any_blocks(spark, monkeypatch):
    draw = random.Random(4)
    words = {f"l{i:03}": ["".join(draw.choices("abcdefghijklmnop", k=8)) for _ in range(6)] for i in range(230)}
    rows = [(name, " ".join(draw.choices(known, k=30))) for name, known in words.items() for _ in range(1 + (name < "l200"))]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, lang string, text string")
    found = {}
    for size in (7, 100, 1_000):
        monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", size)
        found[size] = rows_of(language_id.predict(docs, language_id.fit(docs)), "doc_id", "lang_pred", "score")
    assert [name for _, name, _ in sorted(found[1_000])] == [name for name, _ in rows]
    assert found[7] == found[100] == found[1_000]


def test_texts_are_learned_from_all_their_parts(spark):
    draw = random.Random(8)
    header = "shared licence passage of every text " * 100
    words = {name: ["".join(draw.choices("abcdefghijklmnop", k=8)) for _ in range(40)] for name in ("aa", "bb")}
    own = ["".join(draw.choices("qrstuvwxyz", k=8)) for _ in range(2 * language_id.SAMPLE_TEXTS)]
    rows = [(name, header + f"{own[2 * i + (name == 'bb')]} " * 60 + " ".join(draw.choices(known, k=1_000)))
            for i in range(language_id.SAMPLE_TEXTS) for name, known in words.items()]
    profiles = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    held = spark.createDataFrame([(name, " ".join(draw.choices(known, k=30))) for name, known in words.items()], "doc_id string, text string")
    for r in language_id.predict(held, profiles).collect():
        assert r["lang_pred"] == r["doc_id"] and r["score"] > 0.2
    data = [d for block in profiles.blocks for _, _, d in block.value]
    assert all(language_id.DICTIONARY_BYTES - 600 < len(d) <= language_id.DICTIONARY_BYTES for d in data)
    one = language_id.dictionary([[f"a{c} " * 300, f"{c}b " * 300, "", c * 10] for c in own])
    assert all(c.encode() in one for c in own)


def test_simhash_edges(spark, edge_docs, no_docs):
    prints = [(i, brute_fingerprint(t)) for i, t in EDGE_TEXTS]
    wanted = sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints))), key=repr)
    assert rows_of(simhash.near_duplicates(edge_docs), "doc_id", "fingerprint", "component_id") == wanted
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("segments", [simhash.FEW_SEGMENTS, simhash.MANY_SEGMENTS])
def test_links_are_all_pairs_within_the_distance(spark, segments):
    draw = random.Random(5)
    seeds = [draw.getrandbits(64) for _ in range(40)]
    prints = {s ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 6))) for s in seeds for _ in range(6)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    near = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 4}
    links = simhash.link_prints(spark.createDataFrame([(p,) for p in signed], "print bigint"), 4, segments)
    assert {(r["a"], r["b"]) for r in links.collect()} == near


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, None), (201, 200), (200, 201), (202, 201)]
    found = components.connected_components(spark.createDataFrame(links, "a int, b int"), "a", "b")
    wanted = {i: 0 for i in range(21)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200, 202: 200}
    assert {r["node"]: r["component"] for r in found.collect()} == wanted and found.count() == len(wanted)


def test_url_filter_edges(spark):
    rows = [
        (1, None, None), (2, "", "<title>"), (3, "no scheme", ""), (4, "http://NET/es/", "<title>Spam Farm</title>"), (5, "x://a.net/es/?q#f", "<TITLE >spam\nfarm</TITLE>"),
        (6, "http://xnet/es/", ""), (7, "http://com", ""), (8, "http://www.example.com/en/?a", ""), (9, "http://a.example.com/en/x", ""), (9, "http://a.example.com/en/x", ""),
    ]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id int, url string, html string, host string")
    found = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judge(pages, RULES).collect()}
    assert found[1][:3] == ("", "", None) and found[3][:3] == ("", "", None) and found[6][:3] == ("xnet", "/es/", None) and found[7][:3] == ("com", "", None)
    assert found[4] == ("net", "/es/", "net/es/", "block") and found[5] == ("a.net", "/es/", "net/es/", "block")
    assert found[8][2:] == ("www.example.com/en/", "allow") and found[9][2:] == ("example.com/en/", "block")
    assert url_filter.judge(pages.limit(0), RULES).count() == 0 and url_filter.judge(pages, []).where("rule is not null").count() == 0


def test_classes_are_told_by_words(spark):
    rows = [(i, f"http://{'spamfarm' if i % 2 else 'goodnews'}.example.org/x/{i}", "<title>spam farm good news</title>") for i in range(60)]
    rows += [(100, "http://farmspam.example.net/y", None), (101, "http://newsgood.example.net/y", None)]
    rules = [url_filter.Rule("block", "spamfarm.example.org", "/"), url_filter.Rule("allow", "goodnews.example.org", "/")]
    found = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id int, url string, html string"), rules).collect()}
    assert found[100]["verdict"] == "block" and found[101]["verdict"] == "allow" and found[100]["host_words"][:2] == ["farm", "spam"]


def brute_split(name, costs, total):
    """The best words over all starts; of ties the longer last word."""
    best = [(0.0, [])]
    for end in range(1, len(name) + 1):
        found = [(round(best[s][0] + costs.get(name[s:end], math.log(10 / total) - (end - s) * math.log(10)), 9), s) for s in range(end)]
        score, at = max(found, key=lambda f: (f[0], -f[1]))
        best.append((score, best[at][1] + [name[at:end]]))
    return best[-1][1]


def test_all_title_words_split_hosts_at_any_length(spark):
    draw = random.Random(6)
    frequent = sorted({"".join(draw.choices("abcdefgh", k=7)) for _ in range(101_000)})
    rare = ["qu" + "".join(draw.choices("rstuvw", k=n)) for n in (5, 9, 40)]
    titles = [" ".join(frequent[at:at + 1_000]) for at in range(0, len(frequent), 1_000)] * 2 + [" ".join(rare)]
    hosts = ["".join(rare), rare[2] + frequent[0], frequent[1] + frequent[2] + rare[0], "z" * 30 + rare[1], "xyzxyz"]
    pages = [(i, None, f"<title>{t}</title>") for i, t in enumerate(titles)] + [(-i, f"http://{h}/", None) for i, h in enumerate(hosts, 1)]
    found = {r["page_id"]: r["host_words"] for r in url_filter.judge(spark.createDataFrame(pages, "page_id int, url string, html string"), []).collect()}
    total = 2 * len(frequent) + len(rare)
    costs = {w: math.log((1 if w in rare else 2) / total) for w in frequent + rare}
    assert {-i: brute_split(h, costs, total) for i, h in enumerate(hosts, 1)} == {i: w for i, w in found.items() if i < 0}
    assert found[-1] == rare and found[0] == []


def test_very_long_hosts_are_split(spark):
    draw = random.Random(9)
    words = sorted({"".join(draw.choices("abcdefgh", k=n)) for n in range(1, 61) for _ in range(3)})
    long = "".join(draw.choices(words, k=3_000))
    pages = [(1, None, f"<title>{' '.join(words)}</title>"), (2, f"http://{long}/", None), (3, f"http://{long[:5_000]}.net/" + "p" * 1_000_000, None)]
    found = {r["page_id"]: r["host_words"] for r in url_filter.judge(spark.createDataFrame(pages, "page_id int, url string, html string"), []).collect()}
    model = url_filter.WordModel(tuple((w, 1) for w in words), len(words))
    assert len(long) > 50_000 and found[2] == model.split(long) and found[3] == [*model.split(long[:5_000]), *model.split("net")]


def test_sharding_edges(spark, edge_docs, no_docs):
    hot = spark.createDataFrame([(7, "same")] * 35_000 + [(i, f"t{i}") for i in range(5_000)] + [(None, None)], "doc_id int, text string")
    for docs, shards in ((edge_docs, 24), (hot, 24), (hot, 1)):
        found = [tuple(r) for r in sharding.shard_rows(docs, shards, bucket_rows=100).collect()]
        assert Counter(r[:3] for r in found) == Counter(
            (r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.select("doc_id", "text").collect())
        sizes = Counter(r[3] for r in found)
        assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
        assert len({(r[3], r[4]) for r in found}) == len(found) and all(0 <= r[4] < sizes[r[3]] for r in found)
    assert sharding.shard_rows(no_docs).count() == 0


def test_slack_moves_fewer_rows(spark):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    homes = {r["doc_id"]: r["shard"] for r in sharding.shard_rows(docs, 8, slack=5.0).collect()}
    moved = []
    for slack in (0.0, 0.1):
        found = sharding.shard_rows(docs, 8, slack=slack).collect()
        moved.append(sum(homes[r["doc_id"]] != r["shard"] for r in found))
        assert max(Counter(r["shard"] for r in found).values()) <= 375 * (1 + slack) + 1
    assert moved[1] < moved[0] < 1_500
    grown = {r["doc_id"]: r["shard"] for r in sharding.shard_rows(docs, 9, slack=5.0).collect()}
    assert all(s in (homes[d], 8) for d, s in grown.items())


def test_quality_classifier_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (4, 0), (None, 1), (7, None), (77, 1), (9, 1)], "doc_id bigint, quality int")
    model = quality_classifier.fit(edge_docs, labels, "quality", F.lit(True))
    found = quality_classifier.predict(edge_docs, model).collect()
    assert len(found) == len(EDGE_TEXTS) and all(0 <= r["score"] <= 1 for r in found)
    nothing = quality_classifier.fit(no_docs, labels.limit(0), "quality", F.lit(True))
    assert all(abs(r["score"] - 0.5) < 0.2 for r in quality_classifier.predict(edge_docs, nothing).collect())
    assert quality_classifier.predict(no_docs, model).count() == 0


def test_labels_meet_documents_with_clashing_columns(spark, edge_docs):
    labels = spark.createDataFrame([(5, 1), (4, 0), (9, 1)], "doc_id bigint, quality int")
    plain = quality_classifier.fit(edge_docs, labels, "quality", F.lit(True))
    names = ["label", "order", "_key", "owner", "numbers", "values", "x", "n", "key", "score", "model"]
    clashing = edge_docs.select("doc_id", "text", "n_chars", *[F.lit(n).alias(n) for n in names])
    model = quality_classifier.fit(clashing, labels.withColumns({n: F.lit(n) for n in ("label", "_key", "order")}), "quality", F.lit(True))
    assert model.to_bytes() == plain.to_bytes()
    assert rows_of(quality_classifier.predict(clashing, model), "doc_id", "score") == rows_of(quality_classifier.predict(edge_docs, plain), "doc_id", "score")


def test_machine_sums_all_pairs():
    draw = np.random.default_rng(3)
    machine = quality_classifier.Machine(0.1, draw.normal(size=20), draw.normal(size=(20, 4)) * 0.3)
    numbers, values = np.array([3, 7, 7, 11]), np.array([0.5, 0.2, 0.9, 1.0])
    raw = 0.1 + sum(machine.weights[i] * x for i, x in zip(numbers, values))
    raw += sum(
        machine.factors[numbers[a]] @ machine.factors[numbers[b]] * values[a] * values[b] for a in range(4) for b in range(a)
    )
    assert machine.score(numbers, values) == pytest.approx(1 / (1 + np.exp(-raw)))


def brute_hits(items, data, window):
    words = [w for block in decontaminate.words_of(data) for w in block]
    hit, names = set(), set()
    for name, text in items:
        item = [w for block in decontaminate.words_of(text) for w in block]
        size = min(window, len(item))
        for i in range(len(item) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j:j + size] == item[i:i + size]:
                    names.add(name)
                    hit |= set(range(j, j + size))
    return hit, names


def test_automaton_against_all_windows():
    draw = random.Random(2)
    for _ in range(300):
        letters, window = "abcdefgh"[: draw.choice([2, 3, 6])], draw.choice([1, 2, 3, 4])
        make = lambda n: " ".join(draw.choice(letters) for _ in range(n)).encode()
        items = [(str(i), make(draw.randint(0, 9))) for i in range(draw.randint(0, 5))]
        data = make(draw.randint(0, 40))
        automaton = decontaminate.Automaton.of(items, window)
        spans, names = automaton.scan(automaton.numbers(data))
        assert ({i for a, b in spans for i in range(a, b)}, names) == brute_hits(items, data, window)


def test_decontamination_edges(spark, edge_docs, no_docs):
    items = [(1, "the cat sat on the mat"), (2, "A,b;c d. E a b c d e a b c d"), (None, "no ID"), (3, None), (4, "..."), (1, "one")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    flat = [("" if i is None else str(i), t.encode()) for i, t in items if t is not None]
    for size in (10_000, 10):
        found = decontaminate.scan(edge_docs, bench, block_bytes=size)
        wanted = []
        for i, text in EDGE_TEXTS:
            if i == 9:
                continue
            hit, names = brute_hits(flat, (text or "").encode(), 13)
            n = len(re.findall(rb"[0-9a-zA-Z\x80-\xff]+", (text or "").encode()))
            wanted.append((i, n, len(hit), sorted(names), bool(hit) and 20 * len(hit) >= n))
        got = found.where("doc_id is null or doc_id <> 9")
        assert rows_of(got, "doc_id", "n_words", "n_hit", "items", "contaminated") == sorted(wanted, key=repr)
        long = found.where("doc_id = 9").first()
        assert (long["n_words"], long["n_hit"], long["items"]) == (300_000, 299_999, ["2"])
    assert decontaminate.scan(edge_docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.scan(no_docs, bench).count() == 0


def test_long_spans_are_cut_and_the_rest_stays(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    clean = "Ärger, über alles. " + " ".join(f"w{i}" for i in range(500))
    rows = [(1, f"{clean} {passage.upper()}! Ende é", 0, "x"), (2, passage, 0, "y"), (3, clean, 7, None), (4, None, None, None)]
    docs = spark.createDataFrame(rows, "words int, text string, n_chars bigint, spans string")
    found = {r["words"]: r for r in decontaminate.clean(docs, spark.createDataFrame([(1, passage)], "item_id int, text string")).collect()}
    assert set(found) == {1, 3, 4} and found[3] == docs.where("words = 3").first() and found[4]["text"] is None
    assert found[1]["text"] == f"{clean} ! Ende é" and found[1]["n_chars"] == len(found[1]["text"])


def test_words_encode_as_the_library_does():
    encoder = token_files.WordEncoder(public_tokenizers.path(WORD_TOKENIZER))
    draw = random.Random(4)
    pieces = [
        "a", "Th", "ing", "É", "ß", "ÿ", "Ö", "÷", "×", "'s", "'S", "'re", "''", "1", "42", "!?", "#", "<|endoftext|>", "<|", "|>", "é", "e\u0301",
        "İ", "Σ", "σς", "日本", "\u00a0", "\u2003", "\x1c", "\x00", "😀", " ", "  ", "\n", "\t", "ª", "²", "½", "-", "_", "Ω", "ﬁ", "\u0338", "=",
    ]
    for _ in range(3_000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))
        ids = np.frombuffer(b"".join(encoder.encode(text.encode())), encoder.kind).tolist()
        assert ids == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_token_files_edges(spark, edge_docs, no_docs):
    path = public_tokenizers.path(WORD_TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    found = rows_of(token_files.stored_documents(edge_docs, path), "doc_id", "n_tokens", "ids")
    ids = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in EDGE_TEXTS]
    assert found == sorted(((i, len(x), bytearray(np.array(x, "<u4").tobytes())) for i, x in ids), key=repr)
    starts = sorted(r["start"] for r in token_files.stored_documents(edge_docs, path).collect())
    assert starts[0] == 0 and len(set(starts)) == len(EDGE_TEXTS)
    assert token_files.stored_documents(no_docs, path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 511, 512, 513, 5_000])
def test_blocks_round_trip_from_every_checkpoint(n):
    draw = np.random.default_rng(n)
    ids = np.minimum(draw.geometric(0.02, n), 900).astype(np.uint32)
    table = token_files.Frequencies.of(np.bincount(np.concatenate([ids, [3]]), minlength=1_000))
    assert int(table.frequencies.sum()) == 1 << token_files.PRECISION
    data = token_files.encode_block(ids, table, lanes=16, every=8) if n else token_files.encode_block(ids, table)
    back, size = token_files.decode_block(memoryview(data), table, every=8)
    assert back.tolist() == ids.tolist() and size == len(data)
    if n == 5_000:
        with pytest.raises((ValueError, IndexError)):
            token_files.decode_block(memoryview(data[:-400] + bytes(400)), table, every=8)


def test_pipeline_keeps_columns_and_handles_edges(spark, edge_docs, no_docs, tmp_path):
    spark.createDataFrame([(1, "the cat sat on the mat the cat sat on the mat the cat")], "item_id int, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_stages_take_columns_of_any_name(spark, edge_docs, tmp_path):
    """Every name used inside the stages, as an extra column: the same documents stay, with all their columns."""
    spark.createDataFrame([(1, "the cat sat on the mat the cat sat on the mat the cat")], "item_id int, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    names = ["_doc_id", "_mark", "key", "mark", "print", "body", "words", "spans", "items", "at", "arc", "c0", "c1", "n", "row", "kept", "order",
             "label", "owner", "held_out", "component_id", "fingerprint", "n_words", "host", "ids", "decoded", "h", "part", "block"]
    plain = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    clashing = plain.select(*[F.lit(n).alias(n) for n in names], *plain.columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, str(tmp_path))
        assert out.columns == clashing.columns and all(r[n] == n for r in out.collect() for n in names)
        assert rows_of(out, *plain.columns) == rows_of(stage(spark, plain, str(tmp_path)), *plain.columns)
    assert rows_of(corpus_pipeline.STAGES[-1][1](spark, clashing, ""), "*") == rows_of(corpus_pipeline.STAGES[-1][1](spark, plain, ""), "*")


def test_rows_meet_key_tables_by_one_plan(spark, small, edge_docs):
    for docs in (edge_docs, spark.read.parquet(f"{small}/documents.parquet")):
        keys = corpus_pipeline.listed(corpus_pipeline.named(docs), "keys")
        joined = docs.join(keys, corpus_pipeline.same_row(), "left_anti")
        assert joined.count() == 0
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    judged = corpus_pipeline.apply_quality_rules(spark, edge_docs, "")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in judged and "Broadcast" not in judged


def test_one_row_of_each_group_stays(spark):
    long, other = "the same long text of many words " * 20, "quite another text about different things " * 20
    rows = [(5, long), (5, long), (3, long + "."), (None, other), (None, other), (9, other), (7, "alone"), (7, "alone too")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    groups = brute_components([(n, brute_fingerprint(t)) for n, (_, t) in enumerate(rows)])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert len(kept) == len(set(groups)) and {r["text"] for r in kept} >= {"alone", "alone too", other}


def test_rows_without_id_are_judged_one_by_one(spark):
    good = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(None, good, "s"), (None, "short", "s"), (1, good, "s"), (1, "short", "s")], "doc_id bigint, text string, source string")
    many = docs.unionByName(docs.where(F.col("text") == good)).unionByName(docs.where(F.col("text") == good))
    assert sorted(r["text"] for r in corpus_pipeline.apply_quality_rules(spark, many, "").collect()) == [good] * 6


def test_pipeline_run_against_its_parts(spark, small):
    """Stage by stage in plain Python, from the rows the language stage keeps."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, small).collect()
    good = [r for r in kept if (m := brute_measures(r["text"]))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    components_of = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in good])
    single = [r for r, c in zip(good, components_of) if r["doc_id"] == c]
    bench = [(str(r["item_id"]), r["text"].encode()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    automaton = decontaminate.Automaton.of(bench)
    plain, wanted = library(), {}
    for r in single:
        data = r["text"].encode()
        numbers = automaton.numbers(data)
        spans = decontaminate.merged(automaton.scan(numbers)[0])
        hit = sum(b - a for a, b in spans)
        if hit and 20 * hit >= len(numbers):
            continue
        text = decontaminate.cut_spans(data, spans, 13).decode()
        ids = np.array(plain.encode_ordinary(text), "<u4").tobytes()
        wanted[r["doc_id"]] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    found = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == wanted and len(found) == len(wanted)
