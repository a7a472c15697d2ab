"""The corpus operators against brute force, on awkward rows and on empty tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from vitrine.llm import block_names, compression_quality, labels, mixing, prefix_bpe, quality_rules, queries, simhash, suffix_repeats, toxicity, url_templates, warc_zstd

DOCS = "doc_id long, text string, lang string, source string, n_chars long, name string, hash string, row string, node string, gram string, k1 string, words string, id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(seed: int, count: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("aeioustrnlm") for _ in range(rnd.randint(2, 8))) for _ in range(count))


def awkward_texts() -> list[tuple]:
    base = words(1, 120)
    near = base.replace(base.split()[40], "Zebra", 1)
    passage = words(2, 60)
    repeats = "the same eight words come again and again " * 6
    long = words(3, 9000) + "\n" + passage + "\n" + words(4, 9000)
    texts = [
        base, base, near, base.replace(" ", "\n\t "), "", None, " \n\t", "x", "aa " * 300, "a" * 900, long, passage, words(5, 50) + " " + passage + " é€😀 " + words(6, 40),
        words(7, 30) + "\n" + words(8, 10) + "\n" + words(8, 10), repeats, "*** ### " * 40, "NO!! WAY!! " * 40, "Licence | table | a@b.c", base.upper(), "\u00a0nbsp\u2003em\x1cfs",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (0, texts[0]), (None, passage), (None, None), (5, "another text of a known id")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 3 else "en", "hot" if i is None or i % 3 else None, 1, *["clash"] * 8) for i, t in awkward_texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def sorted_rows(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)


def oracle(sql: str, **tables) -> list:
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows)
    return sorted_rows(con.sql(sql).fetchall())


def arrow(docs) -> pa.Table:
    return docs.toArrow()


# --- 1 -------------------------------------------------------------------------------------------


def brute_repeats(texts: list[bytes], size: int) -> list[tuple]:
    seen = Counter(t[s : s + size] for t in texts for s in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for s in range(len(t) - size + 1):
            if seen[t[s : s + size]] > 1:
                gone[s : s + size] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket", [4096, 1])
def test_repeats_equal_brute_force(docs, bucket):
    rows = awkward_texts()
    want = [(i, *r) for (i, _), r in zip(rows, brute_repeats([(t or "").encode() for _, t in rows], 60), strict=True)]
    assert sorted_rows(suffix_repeats.digest(docs, 60, bucket=bucket).collect()) == sorted_rows(want)


def test_repeats_of_random_texts():
    rnd = random.Random(5)
    pieces = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 60))) for _ in range(6)]
    texts = [b"".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(40)]
    size = 24
    data, offsets = np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])
    by_gram = defaultdict(list)
    for gram, place, low, high in suffix_repeats.picked_places(data, offsets, size):
        for g, p, a, b in zip(gram.tolist(), place.tolist(), low.tolist(), high.tolist(), strict=True):
            by_gram[g].append((p, a, b + size))
    whole, gone = data.tobytes(), np.zeros(len(data), dtype=bool)
    for group in by_gram.values():
        found = suffix_repeats.Contexts([0] * len(group), [p - a for p, a, _ in group], [whole[a:b] for _, a, b in group])
        back, ahead = found.reach(size)
        again = np.zeros((2, len(group)), dtype=int)
        for behind, length, members in found.groups(size):  # the groups cover the same bytes
            again[:, members] = np.maximum(again[:, members], [[behind], [length]])
            assert len({whole[group[m][0] - behind : group[m][0] + length] for m in members}) == 1
        assert (again == [back, ahead]).all()
        for (p, _, _), x, y in zip(group, back.tolist(), ahead.tolist(), strict=True):
            gone[p - x : p + y] = True
    want = [r[1] for r in brute_repeats(texts, size)]
    assert [int(gone[a:b].sum()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == want


def test_repeat_groups_list_every_occurrence(spark):
    passage = words(11, 40)
    rows = [(1, words(12, 30) + " " + passage), (2, passage + " " + words(13, 30)), (3, words(14, 20) + " " + passage + " " + passage)]
    found = suffix_repeats.RepeatIndex(spark.createDataFrame(rows, "doc_id long, text string"), 60).groups().collect()
    assert {r["id"] for r in found} == {1, 2, 3}
    texts = {i: t.encode() for i, t in rows}
    strings = defaultdict(set)
    for r in found:
        strings[r["group"]].add(texts[r["id"]][r["start"] : r["start"] + r["length"]])
    assert all(len(s) == 1 and len(next(iter(s))) >= 60 for s in strings.values())


# --- 2 -------------------------------------------------------------------------------------------


def test_url_templates_equal_sql(spark, none):
    rnd = random.Random(2)
    urls = [None, "", "nothing", "http://", "HTTP://Example.ORG/es/1", "http://example.org/en/17?x#y", "https://a.example.org/en/2", "x://com/fr/", "ftp://b.com/de/9", "http://aorg/x",
            "http://org?x", "a://b://c.org/x", "http://ÄB.Org/", "http://h.net/a/b/c/d/e/f", "http://h.net/a/b/c/d/e/f", "http://h.net//", "http://h.net/line\nbreak"]
    urls += [f"http://wide.net/{rnd.choice('xyz')}/{words(k, 1)}" for k in range(60)]
    urls += [f"http://{rnd.choice(['a', 'b'])}.{rnd.choice(['com', 'net', 'org'])}/{rnd.choice(['de', 'fr', 'en', 'es'])}/{rnd.randint(1, 50)}" for _ in range(300)]
    rows = [(i if i % 50 else None, u, "host") for i, u in enumerate(urls)] + [(3, urls[3], "host")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    got = sorted_rows(url_templates.filter_urls(pages, url_templates.RULES).select(columns).collect())
    assert got == oracle(f"SELECT {', '.join(columns)} FROM ({url_templates.oracle()})", pages=arrow(pages))
    fixed = {r[0]: r[1:] for r in got}
    assert fixed[4] == ("example.org", "/es/1", "example.org/es/", "block") and fixed[5][2:] == ("example.org/en/1", "block") and fixed[6][2:] == ("org/", "allow")
    assert url_templates.filter_urls(pages.limit(0), url_templates.RULES).count() == 0


# --- 3 -------------------------------------------------------------------------------------------


def squeeze(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("weak", [False, True])
def test_block_names_equal_brute_force(docs, weak):
    options = {"block_bytes": 8, "block_hash": (lambda b: F.octet_length(b)) if weak else F.xxhash64}
    groups = defaultdict(list)
    for i, t in awkward_texts():
        groups[squeeze(t)].append((-len(t or ""), i is None, i or 0))
    want = []
    for i, t in awkward_texts():
        best = min(groups[squeeze(t)])
        want.append((i, None if best[1] else best[2], len(groups[squeeze(t)]), hashlib.sha256(squeeze(t).encode()).hexdigest()))
    found = block_names.exact_dedup(docs, **options).collect()
    assert sorted_rows((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == sorted_rows(want)
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_drop_copies_keeps_rows_as_they_are(docs, none):
    left = block_names.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(squeeze(r["text"]) for r in left.collect()) == sorted({squeeze(t) for _, t in awkward_texts()})
    assert block_names.drop_copies(none).count() == 0 and block_names.exact_dedup(none).count() == 0


# --- 4 -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return prefix_bpe.Vocabulary.read(queries.byte_vocabulary()[0])


def test_bpe_equals_the_library(docs, none, vocabulary):
    import tiktoken

    path, pattern = queries.byte_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})
    want = [(i, library.encode_ordinary(t or "")) for i, t in awkward_texts()]
    assert sorted_rows((r["doc_id"], r["ids"]) for r in prefix_bpe.encode(docs, path, pattern).collect()) == sorted_rows(want)
    got = prefix_bpe.digest(docs, path, pattern).collect()
    texts = [(i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (i, ids), (_, t) in zip(want, awkward_texts(), strict=True)]
    assert sorted_rows(got) == sorted_rows(texts)
    assert prefix_bpe.digest(none, path, pattern).count() == 0 and prefix_bpe.encode(none, path, pattern).count() == 0


def test_bpe_appends_and_edits_are_exact(vocabulary):
    rnd = random.Random(9)
    for _ in range(60):
        text = bytes(rnd.choice(b"the ing\xc3\xa9\xff\nab12") for _ in range(rnd.randint(0, 200)))
        coded = prefix_bpe.PrefixEncoding(vocabulary, text)
        assert coded.ids() == vocabulary.merge(text)
        coded.append(b" then")
        assert coded.ids() == vocabulary.merge(text + b" then")
        a = rnd.randint(0, len(text))
        b = rnd.randint(a, min(len(text), a + 6))
        coded.replace(a, b, b"quite")
        assert coded.ids() == vocabulary.merge(text[:a] + b"quite" + text[b:] + b" then")


def test_bpe_edit_recomputes_only_nearby(vocabulary):
    coded = prefix_bpe.PrefixEncoding(vocabulary, words(21, 400).encode())
    assert coded.replace(50, 53, b"x") < 600


# --- 5 -------------------------------------------------------------------------------------------


def test_raking_equals_sql_and_meets_targets(docs, none):
    mixed = mixing.mix(docs).withColumn("weight", F.round("weight", 6))
    columns = ["doc_id", "source", "lang", "topic", "n_tokens", "weight", "copies"]
    assert sorted_rows(mixed.select(columns).collect()) == oracle(f"SELECT {', '.join(columns)} FROM ({mixing.oracle()})", documents=arrow(docs.select("doc_id", "text", "lang", "source")))
    assert mixing.mix(none).count() == 0 and mixing.sample(none).count() == 0


def test_raking_to_given_targets(spark):
    rows = [(s, g, t, n) for (s, g, t), n in np.ndenumerate(np.arange(1, 25).reshape(4, 3, 2))]
    cells = spark.createDataFrame([(f"s{s}", f"l{g}", f"t{t}", int(n)) for s, g, t, n in rows], "source string, lang string, topic string, tokens long")
    shares = {"source": {"s0": 0.4, "s1": 0.3, "s2": 0.2, "s3": 0.1, "s9": 0.5}, "lang": {"l0": 0.5, "l1": 0.25, "l2": 0.25}, "topic": {"t0": 0.7, "t1": 0.3}}
    targets = {m: spark.createDataFrame(list(v.items()), "value string, share double") for m, v in shares.items()}
    fitted = mixing.rake(cells, targets).toPandas()
    fitted["fit"] = fitted.tokens * fitted.weight
    for margin, want in shares.items():
        got = fitted.groupby(margin).fit.sum() / fitted.fit.sum()
        total = sum(v for k, v in want.items() if k != "s9")
        assert all(abs(got[k] - v / total) < 1e-6 for k, v in want.items() if k != "s9")


def test_sample_draws_by_weight(docs):
    drawn = mixing.sample(docs)
    weights = {(r["doc_id"], r["n_tokens"]): r["copies"] for r in mixing.mix(docs).collect()}
    assert drawn.columns == docs.columns
    assert sorted_rows((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in drawn.collect()) == sorted_rows(
        (i, len(WORD.findall(t or ""))) for i, t in awkward_texts() if weights[(i, len(WORD.findall(t or "")))] >= 1
    )


# --- 6, 9 ----------------------------------------------------------------------------------------


def test_classifiers_on_held_out_rows(spark, none):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    known = spark.read.parquet(f"{sf}/labels.parquet")
    for module, label, least in ((toxicity, "toxic", 0.9), (compression_quality, "quality", 0.9)):
        model = module.fit(table, known)
        scored = module.score(table, model)
        rows = scored.join(known, "doc_id").filter("held_out").select(label, "score", "predicted").collect()
        assert sum(r[label] == r["predicted"] for r in rows) / len(rows) >= least
        assert scored.count() == table.count() and scored.filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()
        # Labels of the held-out fold change nothing.
        flipped = known.withColumn(label, F.when(labels.fold("doc_id") == 0, 1 - F.col(label)).otherwise(F.col(label)))
        again = {r["doc_id"]: r["score"] for r in module.score(table, module.fit(table, flipped)).collect()}
        assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in scored.collect())


@pytest.mark.parametrize("module", [toxicity, compression_quality])
def test_classifiers_without_labels(spark, docs, none, module):
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = module.fit(docs, known)
    scored = module.score(docs, model).collect()
    assert len(scored) == len(awkward_texts()) and all(0 <= r["score"] <= 1 for r in scored)
    assert all(r["held_out"] for r in scored if r["doc_id"] is None)
    assert module.score(none, module.fit(none, known)).count() == 0


# --- 7 -------------------------------------------------------------------------------------------


def test_quality_rules_equal_sql(docs, none):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = quality_rules.judge(docs).select(columns).collect()
    assert sorted_rows(got) == oracle(f"SELECT {', '.join(columns)} FROM ({quality_rules.oracle()})", documents=arrow(docs.select("doc_id", "text")))
    want = []
    for i, t in awkward_texts():
        found = WORD.findall(t or "")
        grams = [tuple(found[k : k + 8]) for k in range(len(found) - 7)]
        twice = Counter(grams)
        want.append((i, len(found), len({k + j for k, g in enumerate(grams) if twice[g] > 1 for j in range(8)})))
    assert sorted_rows((r["doc_id"], r["n_words"], r["n_repeat_words"]) for r in got) == sorted_rows(want)
    assert quality_rules.judge(none).count() == 0
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


# --- 8 -------------------------------------------------------------------------------------------


def brute_fingerprint(text: str | None, size: int) -> int:
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force(docs, none):
    rows = simhash.components(docs, 4, 1, 4).collect()
    assert sorted_rows((r["id"], r["f0"] % 2**64) for r in rows) == sorted_rows((i, brute_fingerprint(t, 4)) for i, t in awkward_texts())
    assert simhash.components(none, 4, 1, 4).count() == 0
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns and left.count() < len(awkward_texts())


@pytest.mark.parametrize("unit", [2048, 3])
def test_links_lose_no_pair(spark, unit):
    rnd = random.Random(8)
    values = {rnd.getrandbits(64) for _ in range(150)}
    for centre in list(values)[:12]:
        values |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 5))) for _ in range(12)}
    values = sorted(values)
    nodes = spark.createDataFrame([(i, v - 2**64 if v >= 2**63 else v) for i, v in enumerate(values)], "node long, f0 long")
    links = {(r["u"], r["v"]) for r in simhash.near_links(nodes, 1, 4, unit).collect()}

    def parts(pairs) -> set:
        root = list(range(len(values)))
        for a, b in pairs:
            ra, rb = a, b
            while root[ra] != ra:
                ra = root[ra]
            while root[rb] != rb:
                rb = root[rb]
            root[max(ra, rb)] = min(ra, rb)
        groups = defaultdict(set)
        for i in range(len(values)):
            r = i
            while root[r] != r:
                r = root[r]
            groups[r].add(i)
        return {frozenset(g) for g in groups.values()}

    near = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    assert all((values[a] ^ values[b]).bit_count() <= 4 for a, b in links)
    assert parts(links) == parts(near)


def test_anchors_cover():
    rnd = np.random.default_rng(1)
    x = rnd.integers(0, 2**32, 300, dtype=np.uint32)
    y = x ^ np.array([sum(1 << int(b) for b in rnd.choice(32, rnd.integers(0, 3), replace=False)) for _ in x], dtype=np.uint32)
    found = []
    for values in (x, y):
        row, anchor = simhash.anchors(values)
        assert np.bitwise_count(values[row] ^ anchor).max() <= 2 and len(row) <= 17 * len(values)
        by_row = defaultdict(set)
        for r, a in zip(row.tolist(), anchor.tolist(), strict=True):
            by_row[r].add(a)
        found.append(by_row)
    assert all(found[0][i] & found[1][i] for i in range(len(x)))


# --- 10 ------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    big, other = "<p>" + words(31, 300), "<p>" + words(32, 300)
    rows = [(1, "http://a/", big, "k"), (2, "http://b/\r\nX: y", big, "k"), (3, None, "small", "k"), (4, "u", "small", "k"), (5, "u", None, "k"), (6, "u", "", "k"), (9, "u", big, "k"), (9, "u", big, "k"),
            (None, "u", other, "k"), (None, "u", other, "k"), (7, "u", "é" * 600, "k"), (8, "u", "é" * 600, "k"), (None, "u", big, "k"), (10, "u", words(33, 60000), "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, kind string").repartition(3)
    got = sorted_rows(warc_zstd.round_trip(pages).collect())
    want = []
    groups = defaultdict(list)
    for i, _, t, _ in rows:
        groups[t or ""].append(i)
    for i, _, t, _ in rows:
        data = (t or "").encode()
        known = [x for x in groups[t or ""] if x is not None]
        chief = max(known) if known and len(data) >= 1000 else i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if chief == i else "revisit", None if chief == i else chief))
    assert got == sorted_rows(want)
    assert warc_zstd.round_trip(pages.limit(0)).count() == 0


def test_reader_reports_damage(spark, tmp_path):
    good = warc_zstd.build_record("response", "<urn:uuid:1>", "http://a/", b"hello", "1", None)
    records = [good, good.replace(b"hello", b"hellO"), good.replace(b"Content-Length: 5", b"Content-Length: 6"), good.replace(b"WARC/1.1", b"WORC/1.1"), good.replace(b"WARC-Date", b"WARC-Fate"), good[:-4]]
    archive = warc_zstd.write_archive(records)
    (tmp_path / "a.warc.zst").write_bytes(archive)
    (tmp_path / "b.warc.zst").write_bytes(archive[:-7])
    (tmp_path / "c.warc.zst").write_bytes(b"")
    rows = warc_zstd.read_archives(spark, f"file://{tmp_path}").collect()
    whole = [r for r in rows if r["path"].endswith("a.warc.zst")]
    assert [r["error"] is None for r in whole] == [True, False, False, False, False, False] and bytes(whole[0]["payload"]) == b"hello"
    assert [r["error"] is None for r in rows if r["path"].endswith("b.warc.zst")] == [True, *[False] * 5]


def test_reader_takes_a_compressed_dictionary():
    import zstandard

    record = warc_zstd.build_record("response", "<urn:uuid:1>", "http://a/", b"x" * 100, "1", None)
    dictionary = b"WARC/1.1 response text/html" * 20
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    data = warc_zstd.archive_head(zstandard.compress(dictionary)) + packer.compress(record) * 2
    assert list(warc_zstd.read_archive(data)) == [record, record]
    plain = zstandard.compress(record)
    assert list(warc_zstd.read_archive(plain + plain)) == [record, record]
