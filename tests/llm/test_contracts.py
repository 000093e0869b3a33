"""The queries of the corpus operators against plain versions of them, on whole small tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"


def load(name, order):
    return duckdb.sql(f"select * from '{SF}/{name}.parquet' order by {order}").to_arrow_table().to_pylist()


@pytest.fixture(scope="module")
def docs():
    return load("documents", "doc_id")


def run(spark, name):
    return [r.asDict() for r in queries()[name](spark, SF).collect()]


def test_op1(spark):
    turns = load("conversations", "conv_id, turn")
    turns += [{"conv_id": -7, "turn": i, "role": r, "text": "</s>[INST] ok [/INST]"} for i, r in enumerate(["user", "assistant"])]
    by = defaultdict(list)
    for t in turns:
        by[t["conv_id"]].append((t["role"], t["text"] or ""))
    got = {r["conv_id"]: r for r in run(spark, "op1_chat_windows")}
    assert got.keys() == by.keys()
    for conv, said in by.items():
        learnt = "".join(t for r, t in said if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(said)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert row["formatted_chars"] > sum(len(t) for _, t in said)


def test_op3(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    start, want = 0, []
    for d in docs:
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        want.append({"doc_id": d["doc_id"], "start": start, "n_tokens": len(ids), "ids_crc32": crc})
        start += len(ids)
    assert sorted(run(spark, "op3_token_blocks"), key=lambda r: r["doc_id"]) == want


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op4(spark, docs):
    prints = {d["doc_id"]: fingerprint(d["text"]) for d in docs}
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {k: (f"{prints[k]:016x}", find(k)) for k in ids}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op4_simhash_components")}
    assert got == want


def test_op5(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op5_scaled_sketch")}
    assert len(got) == len(docs)
    long, apart = [], []
    for d, after in zip(docs, docs[1:] + docs[:1]):
        text, row = d["text"] or "", got[d["doc_id"]]
        half = len(text) // 2
        edited = text[: len(text) - half] + (after["text"] or "")[:half]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        if len(text.split()) > 100 and len((after["text"] or "").split()) > 100:
            long.append(row["near_edited"])
            apart.append(row["near_next"])
    assert 0.4 < sum(long) / len(long) < 0.7 and min(long) > 0
    assert sum(apart) / len(apart) < 0.05
    prints = defaultdict(set)
    for d in docs:
        prints[d["text"]].add(got[d["doc_id"]]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_op6(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op6_language_codes")}
    assert got.keys() == {d["doc_id"] for d in docs}
    right = []
    for d in docs:
        row = got[d["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
        if row["held_out"] and d["lang"]:
            right.append(row["lang_pred"] == d["lang"])
    assert sum(right) / len(right) > 0.97


def test_op7(spark, docs):
    rows = run(spark, "op7_hilbert_shards")
    by = {d["doc_id"]: (d["text"] or "").encode() for d in docs}
    assert {r["doc_id"] for r in rows} == by.keys() and len(rows) == len(docs)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(by[r["doc_id"]]) + 1, zlib.crc32(by[r["doc_id"]]))
        assert r["law"] == "rows" and r["grown_shard"] is None
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["hilbert"] for r in order] == sorted(r["hilbert"] for r in rows)


def test_op8(spark, docs):
    rows = run(spark, "op8_entropy_mix")
    assert rows and sorted(rows, key=lambda r: r["doc_id"]) == sorted(run(spark, "op8_entropy_mix"), key=lambda r: r["doc_id"])
    words = {d["doc_id"]: len((d["text"] or "").encode().split()) for d in docs}
    source = {d["doc_id"]: d["source"] for d in docs}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == words[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, full = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        want = {s: 3 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        above = {s for s in names if s not in full and want[s] > 3 * sizes[s]}
        if not above:
            break
        full |= above
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 0.01 * want[s]


def test_op9(spark, docs):
    items = load("benchmark", "item_id")
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in (d["text"] or "")}
    got = {(r["doc_id"], r["item_id"]) for r in run(spark, "op9_spaced_seeds")}
    assert want <= got and len(got - want) <= 0.1 * len(want)


def test_op10(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    got = {r["page_id"]: r for r in run(spark, "op10_url_aliases")}
    pages = load("pages", "page_id")
    assert len(got) == len(pages)
    for p in pages:
        host = path = ""
        if p["url"] and "://" in p["url"]:
            rest = p["url"].split("://", 1)[1]
            end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:end].lower(), rest[end:].split("#")[0].split("?")[0]
        fit = [(len(h + s), h + s, v) for v, h, s in rules if (host == h or host.endswith("." + h)) and path.startswith(s)]
        row = got[p["page_id"]]
        assert (row["host"], row["path"]) == (host, path)
        assert row["rule"] == (max(fit)[1] if fit else None)
        assert row["verdict"] == (max(fit)[2] if fit else "allow")


def test_op2(spark, docs):
    rows = {r["doc_id"]: r for r in run(spark, "op2_substring_dedup")}
    assert len(rows) == len(docs)
    # A passage of two whole sentences and twenty words stays in one document only.
    changed = [d for d in docs if rows[d["doc_id"]]["changed"]]
    assert changed and len(changed) < len(docs) / 2
    for d in docs:
        row = rows[d["doc_id"]]
        assert row["changed"] == (row["n_removed"] > 0)
        if not row["changed"]:
            assert row["text"] == d["text"]
    again = Counter(d["text"] for d in docs)
    for text, n in again.items():
        if n > 1 and len(text.split()) > 100:
            kept = [rows[d["doc_id"]]["text"] for d in docs if d["text"] == text]
            assert sum(len(k) > 0.5 * len(text) for k in kept) <= 1


def test_pipeline(spark, docs):
    rows = run(spark, "pipeline")
    by = defaultdict(int)
    for r in sorted(rows, key=lambda r: r["start"]):
        by[r["doc_id"]] += 1
    ends = [r["start"] + r["n_tokens"] for r in sorted(rows, key=lambda r: r["start"])]
    assert [r["start"] for r in sorted(rows, key=lambda r: r["start"])] == [0, *ends[:-1]]
    assert max(by.values()) <= 3 and by.keys() <= {d["doc_id"] for d in docs}
    leaks = {r["doc_id"] for r in run(spark, "op9_spaced_seeds")}
    assert not by.keys() & leaks
