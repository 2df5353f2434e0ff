"""The queries against SQL, or against brute force, exact round trips and held-out accuracy."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from checks.compare import connect, plain, sorted_rows
from tableloom.llm import queries, url_filter
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = connect(SMALL).execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_byte_bpe_is_the_library_and_round_trips(spark, documents):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(queries.op2_byte_bpe(spark, SMALL))
    assert len(found) == len(documents)
    for doc_id, text in documents:
        ids = library.encode_ordinary(text)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        row = found[doc_id]
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_language_is_learned(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()}
    found = queries.op4_language_id(spark, SMALL).collect()
    assert len(found) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.9 * len(held)


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Union-find over all pairs of (id, fingerprint)."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= 4:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(prints):
        groups[root(i)].append(doc_id)
    return [min((d for d in groups[root(i)] if d is not None), default=None) for i in range(len(prints))]


def test_simhash_against_all_pairs(spark, documents):
    prints = [(i, brute_fingerprint(t)) for i, t in documents]
    wanted = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, brute_components(prints))}
    found = queries.op5_simhash(spark, SMALL).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == wanted
    assert len(found) == len(wanted)


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def test_url_rules_come_first(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()}
    for r in queries.op6_url_filter(spark, SMALL).collect():
        host, path, rule = brute_url(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert r["verdict"] == (rule.verdict if rule else r["verdict"]) and r["verdict"] in ("allow", "block")


def test_url_words_are_split_where_words_are_known():
    model = url_filter.WordModel((("farm", 50), ("the", 900), ("spam", 40), ("rat", 30), ("there", 20)))
    assert model.split("spamfarm") == ["spam", "farm"]
    assert model.split("therat") == ["the", "rat"]
    assert model.split("") == []


def test_shards_hold_rows_evenly(spark, documents):
    found = queries.op7_sharding(spark, SMALL).collect()
    assert len(found) == len(documents)
    texts = dict(documents)
    slots = defaultdict(list)
    for r in found:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(24)]
    assert set(slots) <= set(range(24)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_quality_is_learned(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = queries.op8_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    good = [r["score"] for r in held if truth[r["doc_id"]] == 1]
    bad = [r["score"] for r in held if truth[r["doc_id"]] == 0]
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_token_files_hold_the_librarys_ids(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = by_id(queries.op10_token_files(spark, SMALL))
    start = 0
    for doc_id, text in sorted(documents):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert tuple(found[doc_id])[1:] == (start, len(ids), crc)
        start += len(ids)


def test_every_query_is_registered():
    import __spark_entry__ as entry_module

    numbers = Counter(n.split("_")[0] for n in entry_module.queries() if n.startswith("op"))
    assert numbers == Counter(f"op{n}" for n in range(1, 14)) and "pipeline" in entry_module.queries()
    assert plain(1.0) == 1.0
