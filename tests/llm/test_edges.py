"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names; and parts tested alone."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daywise.llm import chat_format as chat, decontaminate as seeds, language_id as lang, mixing, sharding, simhash
from daywise.llm import sketch, substring_dedup as spans, token_output as tokens, url_filter as urls
from daywise.llm.components import connected_components
from daywise.session import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
# Names that operators use inside, on columns that are none of their business.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rank int, fp string, hash int, component_id int"
LONG = " ".join(f"word{i % 997}" for i in range(200_000))
EDGES = [
    (1, "a b c d e f g. h i j k l m n o p.", "en", "s", 1),
    (1, "a b c d e f g. h i j k l m n o p.", "en", "s", 1),
    (2, "a b c d e f g. h i j k l m n o p.", None, None, None),
    (3, "", "en", "s", None),
    (4, None, None, None, None),
    (None, "no id here", "fr", "t", 1),
    (None, None, None, None, None),
    (5, " \n\t ", "en", "", 1),
    (6, "12 34 !?", "en", "t", 1),
    (7, LONG, "en", "t", 1),
    (8, "one", "fr", "t", 1),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, 9, "x", 9, 9) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, EDGES)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def by_id(df, *columns):
    found = {}
    for r in df.collect():
        found.setdefault(r.doc_id, []).append(tuple(r[c] for c in columns))
    return found


def test_simhash(docs, none):
    got = by_id(simhash.near_duplicates(docs), "fp", "component_id")
    assert sum(map(len, got.values())) == len(EDGES)
    assert got[1][0] == got[1][1] and got[1][0][1] == got[2][0][1] == 1
    assert {got[i][0] for i in (3, 4, 5)} == {(0, 3)} and (0, 3) in got[None]
    assert got[7][0][1] == 7
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("cell", [4096, 20])
def test_links_connect_what_brute_force_connects(spark, cell):
    draws = random.Random(1)
    values = {draws.getrandbits(64) for _ in range(30)}
    for base in list(values)[:10]:
        for _ in range(40):
            x = base
            for _ in range(draws.randrange(1, 8)):
                x ^= 1 << draws.randrange(64)
            values.add(x)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    root = {v: v for v in signed}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {v: v for v in signed} | dict(connected_components(simhash.links(frame, cell=cell)).collect())
    assert got == {v: find(v) for v in signed}


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(chain, "x int, y int")).collect())
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)}
    assert connected_components(spark.createDataFrame([], "x int, y int")).count() == 0


def test_tokens(spark, docs, none):
    path = new_folder(spark, "test-tokens")
    tokens.write_tokens(docs, path, PATH, block_ids=50)
    rows = sorted(tokens.read_index(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert [r.start for r in rows] == list(np.cumsum([0, *(r.n_tokens for r in rows)])[:-1])
    assert rows[5].n_tokens == rows[6].n_tokens == 1 and rows[2].ids_crc32 == rows[3].ids_crc32 == rows[4].ids_crc32
    for block in spark.read.parquet(path).collect():
        code = tokens.block_boundaries(block)
        assert [code[i] for i in range(code.n)] == code.decode().tolist()
        assert code[code.n - 1] == block.n_ids == len(block.ids) // 2
        assert len(tokens.block_names(block)) == block.n_docs
    empty = new_folder(spark, "test-tokens")
    tokens.write_tokens(none, empty, PATH)
    assert tokens.read_index(spark, empty).count() == 0


def test_documents_are_looked_up_in_their_blocks(spark, docs):
    path = new_folder(spark, "test-tokens")
    tokens.write_tokens(docs, path, PATH, block_ids=50)
    asked = spark.createDataFrame([(7,), (1,), (1,), (3,), (None,), (99,)], "doc_id long")
    got = sorted(tuple(r) for r in tokens.read_documents(spark, path, asked).collect())
    encoder = tokens.Encoder(PATH, "<u2", False)
    texts = [(i, text or "") for i, text, *_ in EDGES if i in (1, 3, 7)]
    want = [(i, np.frombuffer(encoder.encode([text])[0], "<u2").tolist() + [0]) for i, text in texts]
    assert got == sorted(want)
    assert tokens.read_documents(spark, path, asked.limit(0)).count() == 0


def test_names_of_a_block():
    for names in ([None, None, 1, 1, 5], [None], [5], [-(2**63), 0, 2**63 - 1], list(range(-500, 3000, 7))):
        unnamed, first, code = tokens.encode_names(names)
        row = {
            "n_docs": len(names), "n_unnamed": unnamed, "first_id": first, "id_low_bits": code.low_bits, "id_low": code.low,
            "id_high": code.high, "id_selects": code.selects,
        }
        assert tokens.block_names(row) == names
        assert [code[i] + first for i in range(code.n)] == names[unnamed:]


def test_manhattan_distance_of_counts():
    a, b = np.random.default_rng(0).integers(0, 2**64, (2, 500), dtype=np.uint64)
    apart = np.bitwise_count(simhash.counts_codes(a) ^ simhash.counts_codes(b)).tolist()

    def counts(fp):
        return [(int(fp) >> 2 * s & 3).bit_count() for s in range(32)]

    assert apart == [sum(abs(x - y) for x, y in zip(counts(p), counts(q))) for p, q in zip(a, b)]
    assert (apart <= np.bitwise_count(a ^ b)).all()


def test_elias_fano_is_small_and_exact():
    draws = np.random.default_rng(0)
    for n, top in ((1, 0), (5, 3), (1000, 10), (3000, 4000), (700, 3)):
        values = np.cumsum(draws.integers(0, top + 1, n))
        code = tokens.EliasFano.encode(values)
        assert code.decode().tolist() == values.tolist() == [code[i] for i in range(n)]
        assert 8 * (len(code.low) + len(code.high)) <= n * (code.low_bits + 3) + 64
    with pytest.raises(IndexError):
        code[n]


def test_pieces_encode_like_whole_texts(docs):
    odd = ["", "  a  b ", "a \n b\t c", "don 't it 's", "<|endoftext|> x<|endoftext|>", "é è　 z", "a \x1c b \x85c", " lead", "trail ", "a  b", "a.\nb, c\n\nd", "\nx. y", "a\n b.", "end.\nX", "e. e.\ne, \u00e9!\n"]
    assert tokens.Encoder(PATH, "<u2").encode(odd) == tokens.Encoder(PATH, "<u2", False).encode(odd)


def test_pieces_are_forgotten_and_learnt_again(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    encoder, whole = tokens.Encoder(PATH, "<u2"), tokens.Encoder(PATH, "<u2", False)
    for text in ["one two, three\nfour.", "two three five", "six\nseven. eight  nine", "two, two. one four.", "", "a"]:
        assert encoder.encode([text, text]) == whole.encode([text, text])


def test_sketches(docs, none):
    rows = sketch.fingerprint_pairs(docs)
    got = by_id(rows, "fingerprint", "edited_sha256", "n_chars", "near_edited", "near_next")
    assert sum(map(len, got.values())) == len(EDGES)
    assert got[1][0] == got[1][1] and got[1][0][0] == got[2][0][0] and got[1][0][4] == 1.0
    assert got[3][0][0] == got[4][0][0] == "" and got[3][0][4] == 1.0
    assert got[7][0][2] == len(LONG)
    assert sketch.fingerprint_pairs(none).count() == 0
    assert sketch.fingerprint_pairs(docs.filter("doc_id = 8")).first().near_edited in (0.0, 1.0)


def test_sketch_of_a_whole_is_the_merge_of_its_parts(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(" ".join(words[:204]), " ".join(words[200:]), " ".join(words))]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for name in "abc":
        df = sketch.with_sketch(df, name, name + "s")
    row = df.select(sketch.merged(F.col("as"), F.col("bs")).alias("m"), "cs", "as").first()
    assert set(row["m"]) - set(row["cs"]) == set() and len(row["m"]) == len(row["cs"]) > 50
    assert set(row["as"]) <= set(row["cs"])


def test_language(spark, docs, none):
    model = lang.train(docs)
    got = by_id(lang.identify(docs, model), "lang_pred", "score")
    assert {got[i][0] for i in (3, 4, 5, 6)} == {("und", 0.0)} and got[8][0][0] in ("en", "fr")
    assert lang.identify(none, lang.train(none)).count() == 0
    assert by_id(lang.identify(docs, lang.train(docs.filter("lang = 'fr'"))), "lang_pred")[7] == [("fr",)]
    for n in (2, 3, 5, 6, 9, 30):
        code = lang.codewords(n)
        assert len({tuple(row) for row in code}) == n


@pytest.mark.parametrize("n", [2, 50])
def test_clean_documents_are_kept_with_any_number_of_languages(spark, n):
    draws = random.Random(14)
    letters = [chr(c) for c in range(0x3B1, 0x3B1 + 300) if chr(c).isalpha()]
    words = {k: ["".join(draws.choice(letters) for _ in range(draws.randint(2, 6))) for _ in range(60)] for k in range(n)}
    # A third of the words of each text are of no language, so margins stay behind those of the training rows.
    noise = ["".join(draws.choice(letters) for _ in range(5)) for _ in range(5000)]
    rows = [
        (i, " ".join(draws.choice(noise) if i % 2 and draws.random() < 0.33 else draws.choice(words[i % n]) for _ in range(80)), f"l{i % n}", "s", 1)
        for i in range(12 * n)
    ]
    rows += [(10**6, "12 345 !", "l0", "s", 1), (10**6 + 1, None, "l0", "s", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, table, "").collect()}
    assert kept == {r[0] for r in rows if r[0] < 10**6}


def test_language_at_chance():
    model = lang.LanguageModel.fit({"a": lang.gram_counts("abab " * 50), "b": lang.gram_counts("cdcd " * 50)})
    assert model.predict("abab abab")[3] < 0.1 and model.predict("cdcd")[3] < 0.1
    assert model.predict("zzzz qqqq xxxx")[3] > 0.3 and model.predict("7")[3] == lang.CHANCE


def test_shard_axes_compare_whole_names(spark):
    names = [f"common_crawl/segment-{i:02d}" for i in range(16)]
    rows = [(i, "t", "en", names[i * 7 % 16]) for i in range(160)] + [(1000, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    ranks = sharding.with_ordinals(table, ["source"])
    got = {r.doc_id: r.source for r in ranks.collect()}
    assert got == {i: float(names.index(s)) if s else None for i, _, _, s in rows}
    placed = sharding.shard(table, {"source": F.col("source")}, shards=4, bits=4)
    by = {}
    for r in placed.join(table, "doc_id").collect():
        by.setdefault(r.shard, set()).add(r.source)
    assert all(len(s - {None}) <= 5 for s in by.values())


def test_range_partitions_follow_the_session(spark, docs):
    from daywise.llm.shared import with_rank

    many = spark.range(300_000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "37")
    try:
        frame = tokens.token_blocks(many, PATH)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"rangepartitioning\(.*, 37\), REPARTITION_BY_COL", plan)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        ranked = with_rank(many, ["doc_id"], "rank")
        assert ranked.filter("rank <> doc_id").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_stages_keep_columns_of_any_name(spark, docs):
    folder = "/root/testdata/sf0.001"
    odd = docs.withColumns({c: F.lit(c) for c in ("_found", "_KEY", "_words", "_copy", "_taken_size", "_key_")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, odd, folder)
        assert rows.columns == odd.columns, name
        assert {(r._found, r._KEY, r._words, r._key_) for r in rows.collect()} == {("_found", "_KEY", "_words", "_key_")}, name


def test_relative_links(spark):
    from urllib.parse import urljoin

    bases = ["https://Example.org/a/b/c.html?q=1#f", "http://h.net", "http://h.net/x/", "http://h.net/x"]
    links = [
        "page.html", "../x", "../../../x?y=1", "./", "..", ".", "/r/./s/../t#u", "//other.net/p", "?id=1", "http://u.net/a?b=c://d", "a/b?to=http://z/", "x:y",
        "mailto:a@b.c", "#top", "d/../e/.", "%20a",
    ]
    pages, want = [], set()
    for base in bases:
        for link in links:
            pages.append((base, f'<p><LINK href="{link}" rel=canonical></p>'))
            if link not in ("x:y", "mailto:a@b.c", "#top"):
                want.add((base, urljoin(base.replace("Example", "example"), link)))
    pages.append(("http://one.net/deep/er/", '<base href="../up/"><meta http-equiv="refresh" content="0; url=to?x=1">' + "long " * 100_000))
    want.add(("http://one.net/deep/er/", "http://one.net/deep/up/to?x=1"))
    pages += [("no scheme", '<link rel="canonical" href="a">'), (None, '<link rel="canonical" href="a">'), ("http://one.net/", None), ("http://one.net/", "")]
    table = spark.createDataFrame([(i, u, h, "k", "r") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, key string, root string")
    assert {tuple(r) for r in urls.page_links(table).collect()} == want
    assert urls.judge(table, urls.rules(spark, [("block", "one.net/deep/up/")])).filter("by = 'alias' and verdict = 'block'").count() == 1


def test_shards(docs, none):
    rows = sharding.shard(docs).collect()
    assert len(rows) == len(EDGES)
    counts = [sum(r.shard == s for r in rows) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert sharding.shard(none).count() == 0


def test_hilbert_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        axes = [F.expr(f"cast((id div {1 << (bits * i)}) % {1 << bits} as int)") for i in range(n)]
        cells = spark.range(1 << (n * bits)).select(F.array(*axes).alias("cell"))
        path = [r.cell for r in cells.withColumn("at", sharding.hilbert_index(F.col("cell"), n, bits)).orderBy("at").collect()]
        assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(path, path[1:]))


def test_written_shards_hold_all_rows(spark, docs):
    unique = docs.filter("doc_id > 1").drop("size", "rank", "hash")
    path = new_folder(spark, "test-shards")
    sharding.write_shards(unique, sharding.shard(unique, shards=2), path)
    assert spark.read.parquet(path).select(unique.columns).exceptAll(unique).count() == 0
    assert spark.read.parquet(path).count() == unique.count()


def test_mixing(docs, none):
    got = by_id(mixing.mix(docs), "size", "source_size", "target", "taken", "source")
    assert sum(map(len, got.values())) == len(EDGES) and got[1][0] == got[1][1]
    assert all(0 <= r[3] <= 3 * r[0] for rows in got.values() for r in rows)
    assert got[4][0][4] is None and got[5][0][4] == ""
    assert mixing.mix(none).count() == 0


def test_targets_stop_at_three_times_a_source(spark):
    rows = [("a", 1000), ("b", 10), ("c", 20), ("d", 500)]
    docs = spark.createDataFrame([(i, "w " * 10, s) for s, n in rows for i in range(n // 10)], "doc_id long, text string, source string")
    got = {r.source: (r.target, r.taken) for r in mixing.mix(docs).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    assert got["b"] == (30.0, 30) and got["c"] == (60.0, 60)
    assert got["a"][0] == pytest.approx(720) and got["d"][0] == pytest.approx(720)
    assert abs(got["a"][1] - 720) <= 5 and abs(got["d"][1] - 720) <= 5


def test_spaced_seeds(spark, docs, none):
    items = [(1, " ".join(f"q{i}" for i in range(30))), (2, None), (3, "too few words"), (None, "x " * 30), (1, " ".join(f"q{i}" for i in range(30)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = [f"q{i}" for i in range(30)]
    swapped = [w if i % 7 != 4 else "other" for i, w in enumerate(words)]
    leaks = [
        (1, "before " * 40 + " ".join(words) + " after" * 40),
        (2, "Some text. " + " ".join(swapped).upper()),
        (3, " ".join(words[10:22])),
        (4, " ".join(words[:6])),
        (5, " ".join(w if i % 2 else "other" for i, w in enumerate(words))),
        (6, " ".join(reversed(words))),
    ]
    table = spark.createDataFrame(leaks, "doc_id long, text string")
    got = {r.doc_id: r for r in seeds.contaminated(table, bench).collect()}
    assert got.keys() == {1, 2, 3}
    assert (got[1].overlap_words, got[1].equal_words, got[1].first_word) == (30, 30, 40)
    assert got[2].equal_words < got[2].overlap_words
    assert seeds.contaminated(none, bench).count() == 0
    assert seeds.contaminated(docs, bench.limit(0)).count() == 0
    assert seeds.contaminated(docs, bench).count() == 0


def overlaps(doc, item, least=10, share=0.8):
    """(words, equal words) of the longest overlap of two lists of words, over all ways to lay them side by side."""
    found = (0, 0)
    for shift in range(1 - len(item), len(doc)):
        same = [doc[i] == item[i - shift] for i in range(max(0, shift), min(len(doc), shift + len(item)))]
        if len(item) < least:
            found = max(found, (len(item), len(item)) if sum(same) == len(item) else (0, 0))
            continue
        for a in range(len(same)):
            for b in range(a + max(least, found[0]), len(same) + 1):
                if sum(same[a:b]) >= share * (b - a) - 1e-9:
                    found = max(found, (b - a, sum(same[a:b])))
    return found


def test_spaced_seeds_against_all_pairs(spark):
    draws = random.Random(13)
    items = [[f"i{k}w{j}" for j in range(draws.choice((1, 3, 9, 10, 12, 17, 26)))] for k in range(24)]
    items += [["a", "b"] * 8, ["c"] * 12, ["d"] * 4]
    docs = []
    for k in range(150):
        item = draws.choice(items)
        begin = draws.randrange(len(item))
        part = [w if draws.random() < 0.85 else "other" for w in item[begin if draws.random() < 0.3 else 0 :]]
        docs.append([f"x{draws.randrange(50)}" for _ in range(draws.randrange(8))] + part + [f"y{draws.randrange(50)}" for _ in range(draws.randrange(8))])
    docs += [["a", "b"] * 20, ["c"] * 60, ["d"] * 3, []]
    table = spark.createDataFrame([(i, " ".join(d), "x") for i, d in enumerate(docs)], "doc_id long, text string, stretch string")
    bench = spark.createDataFrame([(i, " ".join(d), 1) for i, d in enumerate(items)], "item_id long, text string, seed int")
    got = {(r.doc_id, r.item_id): (r.overlap_words, r.equal_words) for r in seeds.contaminated(table, bench).collect()}
    want = {(i, j): overlaps(d, w) for i, d in enumerate(docs) for j, w in enumerate(items)}
    want = {k: v for k, v in want.items() if v[0]}
    assert got.keys() <= want.keys() and len(got) >= 0.98 * len(want)
    assert sum(got[k] == want[k] for k in got) >= 0.98 * len(got) > 80


def test_any_ten_words_with_two_changed_are_found():
    from itertools import combinations

    words = np.arange(1, 11, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for changed in combinations(range(10), 2):
        other = words.copy()
        other[list(changed)] = 7
        assert any((seeds.seed_hashes(words, m) == seeds.seed_hashes(other, m)).any() for m in seeds.MASKS)


def test_seed_hits_far_apart_and_repeated_words(spark):
    item = [f"w{i}" for i in range(2000)]
    torn = [w if i < 15 or i >= 1985 or i % 6 else "other" for i, w in enumerate(item)]
    table = spark.createDataFrame([(1, " ".join(torn)), (2, "x " * 20_000), (3, "短い問題です答え")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "x " * 30), (3, "問題です"), (4, "w1")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.overlap_words, r.first_word) for r in seeds.contaminated(table, bench).collect()}
    assert got == {(1, 1): (2000, 0), (2, 2): (30, 0), (3, 3): (4, 2), (1, 4): (1, 1)}


def test_repeated_spans(spark, docs, none):
    passage = " ".join(f"This is sentence number {i} of a passage." for i in range(8))
    texts = [(1, f"Start one. {passage} End one."), (2, f"Start two. {passage} End two."), (3, "Nothing in common here. At all."), (4, None)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in spans.remove_repeats(table).collect()}
    assert got[1].text == texts[0][1] and got[3].text == texts[2][1] and got[4].text is None
    assert got[2].text == "Start two. End two." and got[2].n_removed == 8
    assert spans.remove_repeats(docs).count() == len(EDGES)
    assert spans.remove_repeats(none).count() == 0


def test_spans_against_all_pairs(spark):
    """Every run of pieces that is a span, compared with every other by its words."""
    draws = random.Random(11)
    pool = [" ".join(f"w{draws.randrange(10**6)}" for _ in range(draws.randint(1, 14))) + draws.choice((".", "!", "?\"", "\n", "")) for _ in range(12)]
    texts = [" ".join(draws.choice(pool) for _ in range(draws.randint(0, 14))) for _ in range(80)] + ["漢字。" * 9, "漢字。" * 12, None, "", " \n"]
    rows = [(draws.choice((None, 1, 2, 3, *range(10, 60))), t) for t in texts]
    rows = list({r: None for r in rows})
    found = []
    for name, text in rows:
        bounds = spans.sentences(text) if text else []
        words = [re.findall(spans._WORD, text[a:b]) for a, b in bounds]
        n, size = len(words), [len(w) for w in words]
        runs = set()
        for at in range(n):
            fits = [end for end in range(at + 1, n + 1) if sum(size[at:end]) >= 20 and (end - at >= 2 or size[at] >= 20)]
            runs |= {(at, min(fits))} if fits else set()
            fits = [begin for begin in range(at + 1) if sum(size[begin : at + 1]) >= 20 and (at + 1 - begin >= 2 or size[at] >= 20)]
            runs |= {(max(fits), at + 1)} if fits else set()
        if not runs and sum(size):
            runs = {(0, n)}
        found.append((bounds, {(a, b, tuple(w for piece in words[a:b] for w in piece)) for a, b in runs}))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {(r.doc_id, r.text): r.h for r in table.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashes[rows[i]]))
    want = []
    for rank, i in enumerate(order):
        bounds, mine = found[i]
        gone = set()
        for a, b, run in mine:
            earlier = any(run == other for j in order[:rank] for _, _, other in found[j][1])
            if earlier or any(run == other and c < a for c, _, other in mine):
                gone |= set(range(a, b))
        kept = "".join(rows[i][1][x:y] for k, (x, y) in enumerate(bounds) if k not in gone) if rows[i][1] is not None else None
        want.append((rows[i][0], kept, len(bounds), len(gone), bool(gone)))
    got = [tuple(r) for r in spans.remove_repeats(table).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[4] for r in got) > 20


def test_texts_that_share_an_id(spark):
    draws = random.Random(12)

    def sentence(n):
        return " ".join(f"w{draws.randrange(10**9)}" for _ in range(n)) + "."

    shared, own, other, whole = (" ".join(sentence(11) for _ in range(k)) for k in (4, 6, 10, 5))
    for name in (9, None):
        rows = [(-5 if name else None, shared), (name, f"{own} {shared}"), (name, other), (name, whole), (name, whole), (name, None), (name, None), (name, "")]
        rows += [(12, whole), (7, "a b"), (7, "a b"), (7, "a b")]
        got = spans.remove_repeats(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, text_hash string"))
        texts = sorted(((r.doc_id, r.text) for r in got.collect() if r.doc_id is not None), key=str)
        mine = sorted(str(r.text) for r in got.collect() if r.doc_id == name)
        assert got.count() == len(rows) and (12, "") in texts and [t for i, t in texts if i == 7] == ["", "", "a b"]
        if name:
            assert sorted(mine) == sorted([f"{own} ", other, whole, "", "", "None", "None"])
        else:
            # The hash decides which of two texts without an id comes first.
            assert other in mine and mine.count(whole) == 1 and mine.count("None") == 2
            assert (shared in mine) != (f"{own} {shared}" in mine)


def test_copies_end_up_empty(spark):
    draws = random.Random(3)

    def sentence(n):
        return " ".join(f"w{draws.randrange(10**9)}" for _ in range(n)) + "."

    wholes = [" ".join(sentence(n) for n in sizes) for sizes in ([15, 15, 4], [9, 9, 9, 2, 3], [22, 3], [3], [4, 5], [1] * 30)]
    shared = " ".join(sentence(n) for n in (14, 13, 12, 2, 3))
    texts = [*wholes, *wholes, f"{sentence(30)} {shared} {sentence(30)}", f"{sentence(8)} {shared} {sentence(8)}"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in spans.remove_repeats(table).collect()}
    n = len(wholes)
    assert [got[i] for i in range(n)] == wholes and {got[n + i] for i in range(n)} == {""}
    assert got[2 * n] == texts[2 * n] and got[2 * n + 1] == texts[2 * n + 1].replace(shared + " ", "")


def test_repeats_inside_sentences(spark):
    draws = random.Random(4)

    def words(n, marks=True):
        return [f"w{draws.randrange(10**9)}" + ("." if marks and draws.random() < 0.07 else "") for _ in range(n)]

    texts, shared = [], []
    for k in range(60):
        window = words(51, k % 2)
        shared.append(window)
        texts += [" ".join(words(20 + k % 7, k % 2) + window + words(30, k % 2)) for _ in range(2)]
    # No word of these is chosen by a few low bits of its hash alone; the third has no white space.
    cycle = " ".join(["alpha beta gamma delta epsilon zeta eta"] * 10)
    unspaced = "".join(chr(0x4E00 + draws.randrange(9000)) + "。" * (i % 9 == 8) for i in range(90))
    texts += [cycle, cycle, f"{'始' * 5}。{unspaced}", f"{'終' * 4}。{unspaced}"]
    got = {r.doc_id: r.text for r in spans.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, window in enumerate(shared):
        assert got[2 * k] == texts[2 * k]
        left = got[2 * k + 1].split()
        own = [w for w in texts[2 * k + 1].split() if w not in set(window)]
        assert [w for w in left if w not in set(window)] == own
        assert sum(w in set(window) for w in left) < 51 / 2
    assert got[121] == "" and got[123] == "終" * 4 + "。"


def test_sentences_are_the_whole_text():
    for text in ("", "a", "One. Two!  Three?\n\nFour", " \n ", LONG[:5000], "x. \n y"):
        places = spans.sentences(text)
        assert "".join(text[a:b] for a, b in places) == text


def test_chat_windows(spark):
    long = [(1, 0, "system", "be kind", 1)] + [(1, i, ("user", "assistant")[i % 2 == 0], f"turn {i} " * 20, 1) for i in range(1, 40)]
    odd = [(2, 0, None, None, 1), (2, 0, None, None, 1), (None, None, "assistant", "<|im_end|> a\\n<\\s>", 1), (3, 5, "assist\nant", "x" * 20_000, 1)]
    table = spark.createDataFrame(long + odd, "conv_id long, turn long, role string, text string, window int")
    windows = chat.format_conversations(table, PATH, budget=200, history_turns=2, history_budget=100).collect()
    mine = sorted((w for w in windows if w.conv_id == 1), key=lambda w: w.window)
    assert len(mine) > 5 and all(w.n_tokens <= 200 for w in mine)
    assert all(chat.parse(w.text)[0][:2] == ("system", "be kind") for w in mine)
    assert any(w.n_repeated > 1 for w in mine)
    new = [t[:2] for w in mine for t in chat.parse(w.text)[w.n_repeated :]]
    assert new == [(r[2], r[3]) for r in long]
    learnt = [chat.unescape(w.text[a:b]) for w in mine for a, b in zip(w.loss_starts, w.loss_ends)]
    assert learnt == [r[3] for r in long if r[2] == "assistant"]
    rest = {w.conv_id: chat.parse(w.text) for w in windows if w.conv_id != 1}
    assert [t[:2] for t in rest[2]] == [("", ""), ("", "")]
    assert rest[None][0][:2] == ("assistant", odd[2][3]) and rest[3][0][0] == "assist\nant"
    assert chat.format_conversations(table.limit(0), PATH).count() == 0


def test_system_turn_above_the_budget(spark):
    turns = [(1, 0, "system", "rule " * 300)] + [(1, i, ("user", "assistant")[i % 2 == 0], f"turn {i}") for i in range(1, 7)]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    windows = sorted(chat.format_conversations(table, PATH, budget=200).collect(), key=lambda w: w.window)
    said = [[t[:2] for t in chat.parse(w.text)] for w in windows]
    assert said == [[turns[0][2:]], *[[turns[0][2:], t[2:]] for t in turns[1:]]]
    assert [w.n_repeated for w in windows] == [0] + [1] * 6


def test_escapes_are_reversible():
    draws = random.Random(0)
    parts = [*chat.CONTROLS, "\\", "<", "|", ">", "[", "]", "s", "/", "\n", "<\\s>", "<\\\\/s>"]
    for _ in range(3000):
        text = "".join(draws.choices(parts, k=draws.randrange(1, 9)))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_url_aliases(spark):
    canonical = '<link rel="canonical" href="{}">'
    refresh = '<meta http-equiv="refresh" content="0;url={}">'
    pages = [
        (1, "http://bad.net/x", None),
        (2, "https://a.com/1", refresh.format("http://bad.net/x")),
        (3, "https://b.com/2#f", canonical.format("https://a.com/1")),
        (4, "https://c.com/3", canonical.format("/4")),
        (5, "https://c.com/4", ""),
        (6, "https://d.com/", canonical.format("http://bad.net/x") + canonical.format("https://good.com/ok/")),
        (7, None, None),
        (8, "no url", "<html>"),
        (1, "http://bad.net/x", None),
        (9, "HTTP://E.com?q=http://bad.net/x", None),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    listed = urls.rules(spark, [("block", "net/"), ("allow", "good.com/ok/")])
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.by) for r in urls.judge(table.filter("page_id <> 6"), listed).collect()}
    assert got[1][2:] == ("net/", "block", "rule") and got[2][2:] == got[3][2:] == (None, "block", "alias")
    assert got[4][3:] == got[5][3:] == ("allow", "default")
    assert got[7][:2] == got[8][:2] == ("", "") and got[9] == ("e.com", "", None, "allow", "default")
    # With page 6 the group has an express allow, which goes before; what a rule blocks stays blocked.
    both = {r.page_id: (r.verdict, r.by) for r in urls.judge(table, listed).collect()}
    assert both[1] == ("block", "rule") and both[2] == both[3] == both[6] == ("allow", "alias")
    assert urls.judge(table, listed).count() == len(pages) and urls.judge(table.limit(0), listed).count() == 0
    log = spark.createDataFrame([("https://c.com/4", "http://bad.net/x")], "origin string, goal string")
    assert {r.page_id: r.verdict for r in urls.judge(table.filter("page_id < 6"), listed, log).collect()}[4] == "block"


def test_alias_query_agrees_with_sql(spark, tmp_path):
    import duckdb

    from daywise.llm.queries import QUERIES, SQL

    canonical, refresh = "<link rel='canonical' href='{}'>", '<meta http-equiv="refresh" content="0;url={}">'
    made = [
        (1, "http://bad.net/x", None), (2, "https://a.com/1", refresh.format("http://bad.net/x?q=1&amp;r=2")),
        (3, "https://b.com/2#f", canonical.format("https://a.com/1")), (4, "http://bad.net/x?q=1&r=2", ""),
        (5, "https://c.org/fr/", canonical.format("http://d.com")), (6, "http://D.com", canonical.format("http://a.com/9")),
        (7, None, "<html>"), (8, "no url", refresh.format("http://bad.net/")), (2, "https://a.com/1", None),
        (None, "http://x.example.net/en/a", canonical.format("http://e.com/?")), (9, "http://e.com/?#top", "<p>"),
        (10, "https://www.example.com/de/", canonical.format("https://c.org/fr/")), (11, "http://net", None),
    ]
    spark.createDataFrame(made, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/pages.parquet").write.parquet(str(tmp_path / "given" / "pages.parquet"))
    for folder, least in ((tmp_path, 3), (tmp_path / "given", 0)):
        frame = QUERIES["op10_url_aliases"](spark, str(folder))
        db = duckdb.connect()
        db.execute(f"create view pages as select * from '{folder}/pages.parquet/*.parquet'")
        want = db.execute(SQL["op10_url_aliases"])
        assert [d[0] for d in want.description] == frame.columns
        want, got = want.fetchall(), [tuple(r) for r in frame.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert sum(r[5] == "alias" for r in got) >= least


def test_pipeline_stages(spark, docs, none):
    folder = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, folder)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {1, 2, 7, 8, None}
    single = stages["simhash_near_dedup"](spark, docs, folder)
    assert single.columns == docs.columns and sorted(r.doc_id or 0 for r in single.collect()) == [0, 0, 1, 3, 6, 7, 8]
    assert stages["benchmark_decontamination"](spark, docs, folder).count() == len(EDGES)
    mixed = stages["source_mixing"](spark, docs, folder)
    assert mixed.columns == docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name


def test_pipeline_stages_tell_rows_without_an_id_apart(spark):
    folder = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    clean = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcd"]
    rows = [(None, item), (None, clean[0]), (1, item + " end"), (1, clean[1]), (2, clean[2])]
    table = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], schema)
    left = stages["benchmark_decontamination"](spark, table, folder).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, clean[0]), (1, clean[1]), (2, clean[2])]
    # Copies without an id, of each other and of a named document; one id with two texts; rows that differ in the source only.
    rows = [(None, clean[0], "s"), (None, clean[0], "s"), (None, clean[1], "s"), (5, clean[1], "s"), (1, clean[2], "s"), (1, clean[3], "s"), (2, clean[3], "s"), (5, clean[1], "t")]
    table = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], schema)
    kept = [stages["simhash_near_dedup"](spark, table.repartition(n), folder).collect() for n in (1, 5)]
    assert sorted((r.doc_id or 0, r.text) for r in kept[0]) == [(0, clean[0]), (1, clean[2]), (1, clean[3]), (5, clean[1])]
    assert sorted(map(str, kept[0])) == sorted(map(str, kept[1]))
