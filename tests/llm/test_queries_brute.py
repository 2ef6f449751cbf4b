"""Every registered query over the small corpus, against plain versions of its contract."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import parity
import pytest

from tarnlake.llm.jump_sharding import jump_hash
from tarnlake.llm.oracles import ORACLES
from tarnlake.llm.queries import QUERIES
from tarnlake.llm.tokens import public_tokenizer


def run(spark, name, folder):
    found = QUERIES[name](spark, folder)
    return [row.asDict() for row in found.collect()]


def code_point_order(source):
    return (source is None, source or "")


@pytest.fixture(scope="module")
def token_ids(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizer())
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in rows}


def checksum(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_op1_drops_recurring_templates(spark, corpus, rows):
    found = {r["doc_id"]: r for r in run(spark, "op1_lines", corpus)}
    drops = brute.template_drops(rows)
    assert len(found) == len(rows)
    assert any(drops.values())
    for doc, text in rows:
        kept = "\n".join(x for i, x in enumerate((text or "").split("\n")) if i not in drops[doc])
        assert found[doc]["dropped_lines"] == len(drops[doc])
        assert found[doc]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    named = [d for d, t in rows if t and "posted on this board" in t]
    assert sum(found[d]["dropped_lines"] > 0 for d in named) == len(named) - 1


def test_op2_takes_near_the_targets(spark, corpus, rows):
    found = run(spark, "op2_mixing", corpus)
    assert Counter(r["doc_id"] for r in found) == Counter(d for d, _ in rows)
    sizes = {d: len(brute.split_words(t)) for d, t in rows}
    by_source = defaultdict(list)
    for r in found:
        assert r["size"] == sizes[r["doc_id"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by_source[r["source"]].append(r)
    order = sorted(by_source, key=code_point_order)
    full = {s: 2.0 * sum(r["size"] for r in by_source[s]) for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left = {}, 1.5 * sum(sizes.values())
    open_sources = list(order)
    while open_sources:  # share by weight, cut at the bound, share the excess again
        level = left / sum(weight[s] for s in open_sources)
        over = [s for s in open_sources if level * weight[s] > full[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_sources}
            break
        target |= {s: full[s] for s in over}
        left -= sum(full[s] for s in over)
        open_sources = [s for s in open_sources if s not in over]
    for source, mine in by_source.items():
        assert mine[0]["target"] == pytest.approx(target[source], rel=1e-9)
        largest = max(r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[source]) <= largest + 1e-6
    again = run(spark, "op2_mixing", corpus)
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in found}


def test_op3_finds_toxic_texts(spark, corpus, rows):
    import fixture_corpus

    toxic = {r["doc_id"]: r["toxic"] for r in fixture_corpus.documents()}
    found = run(spark, "op3_toxicity", corpus)
    assert len(found) == len(rows)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in found if r["held_out"]]
    assert {r["predicted"] for r in held if toxic[r["doc_id"]]} == {1}
    assert sum(r["predicted"] for r in held if not toxic[r["doc_id"]]) <= 1


def test_op4_edits_and_compares(spark, corpus, rows):
    found = {r["doc_id"]: r for r in run(spark, "op4_winnowing", corpus)}
    ordered = sorted(rows)
    prints = {}
    for (doc, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, r = text or "", found[doc]
        half = len(text) // 2
        changed = text[: len(text) - half] + (following or "")[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if changed == text:
            assert r["near_edited"] == 1.0
        if (following or "") == text:
            assert r["near_next"] == 1.0
        if len(brute.split_words(text)) >= 60:
            assert 0.15 < r["near_edited"] <= 1
    assert len(found) == len(rows)


def test_op5_round_trip(spark, corpus, rows, token_ids):
    found = sorted(run(spark, "op5_tokens", corpus), key=lambda r: r["doc_id"])
    start = 0
    for r, (doc, _) in zip(found, sorted(rows), strict=True):
        ids = [*token_ids[doc], 1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, start, len(ids), checksum(ids))
        start += len(ids)


def test_op6_pieces_cover_all_ids(spark, corpus, rows, token_ids):
    found = run(spark, "op6_packing", corpus)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == {d for d, _ in rows}
    for doc, pieces in by_doc.items():
        ids, at = [*token_ids[doc], 2], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == checksum(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
    total = sum(r["length"] for r in found)
    assert len(by_sequence) <= -(-total // 4096) + 2


def test_op7_finds_shared_passages(spark, corpus, rows):
    texts = dict(rows)
    found = run(spark, "op7_passages", corpus)
    linked = {r["doc_id"] for r in found} | {r["match_id"] for r in found}
    for r in found:
        one = brute.split_words(texts[r["doc_id"]])[r["start"] : r["end"]]
        other = brute.split_words(texts[r["match_id"]])[r["match_start"] : r["match_end"]]
        assert len(one) >= 50 and len(other) >= 50
        a, b = set(brute.shingle_counts(" ".join(one))), set(brute.shingle_counts(" ".join(other)))
        assert len(a & b) / len(a | b) == pytest.approx(r["similarity"])
        assert r["similarity"] >= 0.8
    grams = defaultdict(set)
    for doc, text in rows:
        words = brute.split_words(text)
        for i in range(len(words) - 49):
            grams[tuple(words[i : i + 50])].add(doc)
    sharing = {d for docs in grams.values() if len(docs) > 1 for d in docs}
    assert len(sharing) >= 15
    assert sharing <= linked


def test_op8_links_all_near_vectors(spark, corpus):
    import fixture_corpus

    rows = fixture_corpus.embeddings()
    found = {r["vec_id"]: r for r in run(spark, "op8_embeddings", corpus)}
    assert len(found) == len(rows)

    def sound(r):
        v = r["embedding"]
        return r["label"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [r for r in rows if sound(r)]
    unit = np.asarray([r["embedding"] for r in good], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.asarray([r["label"] for r in good])
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    classes = brute.Classes([r["vec_id"] for r in rows])
    counts = Counter()
    for i, j in zip(*np.nonzero(linked), strict=True):
        classes.join(good[i]["vec_id"], good[j]["vec_id"])
        counts[good[i]["vec_id"]] += 1
    assert len(counts) > 40
    for vec, r in found.items():
        assert (r["n_links"], r["component_id"]) == (counts[vec], classes.find(vec))
        assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_op9_shards_by_key(spark, corpus, rows):
    found = run(spark, "op9_sharding", corpus)
    assert len(found) == len(rows)
    texts, slots = dict(rows), defaultdict(list)
    for r in found:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 8)
        assert r["shard"] == jump_hash(np.asarray([r["doc_id"]], np.uint64), 8)[0]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op10_classes_match_all_pairs(spark, corpus, rows):
    found = run(spark, "op10_minhash", corpus)
    assert {r["doc_id"]: r["class_id"] for r in found} == brute.near_classes(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)
    assert sum(not r["kept"] for r in found) >= 11


def test_every_query_has_its_number():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLES)
def test_sql_gives_the_same_rows(spark, corpus, name):
    assert parity.difference(QUERIES[name](spark, corpus), corpus, ORACLES[name]) is None


@pytest.mark.parametrize("name", ORACLES)
def test_sql_over_the_sample_tables(spark, name):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    assert parity.difference(QUERIES[name](spark, folder), folder, ORACLES[name]) is None
