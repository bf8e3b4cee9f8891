"""Folding and run keys of the deduplication by paragraphs and passages."""

import random
import re
import string

import numpy as np
import xxhash
from pyspark.sql import functions as F

from panelforge.llm import paragraphs, passages, queries, reading

LINES = ["", " ", "A", "A  b", " \tA\x0b\x0c b \r", "one two\tthree", "\tÀ É  ñ Z ", "İI ẞß ſ K", "a   b", "Ω  A\r\r B"]


def test_folding_is_that_of_the_plain_rule(spark):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    wanted = [re.sub(r"[\x20\x09-\x0D]+", " ", line.translate(lower)).strip(" ") for line in LINES]
    got = spark.createDataFrame(list(enumerate(LINES)), "i int, line string").select(
        "i", paragraphs.folded(F.col("line")).alias("f")).select("*", paragraphs.words(F.col("f")).alias("n")).orderBy("i").collect()
    assert [r.f for r in got] == wanted
    assert [r.n for r in got] == [w.count(" ") + 1 for w in wanted]


def test_runs_are_keyed_by_two_longs(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words[:30]) + " \n\n" + "  ".join(words[30:]).upper()), (2, ""), (3, "few words")], "doc_id long, text string")
    found = passages.runs(docs)
    assert [(n, t) for n, t in found.dtypes] == [("doc_id", "bigint"), ("key", "bigint"), ("rest", "bigint"), ("at", "int"), ("line", "int"), ("last", "int")]
    rows = found.collect()
    assert rows and {r.doc_id for r in rows} == {1}
    for r in rows:
        whole = xxhash.xxh3_128_digest(" ".join(words[r.at:r.at + passages.RUN]).encode())
        assert (r.key, r.rest) == tuple(int.from_bytes(whole[k:k + 8], "little", signed=True) for k in (0, 8))


def test_runs_that_share_half_a_digest_only_are_no_repeats(spark, monkeypatch):
    docs = spark.createDataFrame([(d, " ".join(f"d{d if d < 3 else 1}w{i}" for i in range(60))) for d in (1, 2, 3)], "doc_id long, text string")
    found = passages.runs(docs).withColumn("key", F.lit(7).cast("long"))
    monkeypatch.setattr(passages, "runs", lambda *a: found)
    assert sorted((r.doc_id, r.first_doc_id) for r in passages.passages(docs).collect()) == [(1, 1), (3, 1)]


def test_band_keys_are_those_of_the_plain_sketch(monkeypatch):
    def plain(text, bands, rows, functions):
        mult, add = (f[:bands * rows] for f in functions)
        mixed = paragraphs.shingle_hashes(text)[:, None] * mult[None, :] + add[None, :]
        mixed ^= mixed >> np.uint64(31)
        low = (mixed * np.uint64(0x9E3779B97F4A7C15)).min(axis=0).reshape(bands, rows)
        return np.array([xxhash.xxh64_intdigest(r.tobytes(), seed=i) for i, r in enumerate(low)], dtype=np.uint64).view(np.int64).tolist()

    bands, rows = paragraphs.bands_for(0.8)
    functions = paragraphs.hash_functions()
    texts = ["", "one", "a b c d e", "a b c d " * 3000, " ".join(f"é{i * i % 97}" for i in range(9000))]
    wanted = [plain(t, bands, rows, functions) for t in texts]
    # no distinct set is made of a line's shingles on the way
    monkeypatch.setattr(paragraphs.np, "unique", None)
    assert [paragraphs.band_keys(t, bands, rows, functions) for t in texts] == wanted


TEXTS = ["", "\n", "One two THREE four five\n\n six  seven", " ".join(f"é{i % 9}" for i in range(70)) + "\n" + "A b " * 40,
         "word " * 90 + "\n\n" + "word " * 60, "\n".join(f"l{i} m{i}" for i in range(50)), " ".join(f"v{i}" for i in range(27)), "x\x0by\r\n\t",
         " ".join(f"v{i}" for i in range(33)), "a b c d " * 900]


def _selected_one_by_one(hashes, run, window):
    """Places of selected runs of one text, straight from the definition."""
    value = []
    for i in range(len(hashes) - run + 1):
        v = 0
        for h in hashes[i:i + run]:
            v = (v * 0x9E3779B97F4A7C15 + int(h)) % (1 << 64)
        v ^= v >> 29
        v = v * 0xBF58476D1CE4E5B9 % (1 << 64)
        value.append(v ^ v >> 32)
    window = min(window, len(value))
    places = {i for k in range(len(value) - window + 1) for i in range(k, k + window) if value and value[i] == min(value[k:k + window])}
    return [i for i in sorted(places) if i == 0 or value[i] != value[i - 1]]


def test_runs_of_several_texts_are_selected_as_of_each():
    for run, window in ((26, 13), (5, 4), (1, 1), (3, 1), (1, 3)):
        hashes = [np.array([xxhash.xxh64_intdigest(w) for w in t.encode().lower().split()], dtype=np.uint64) for t in TEXTS]
        wanted, start = [], 0
        for h in hashes:
            one = _selected_one_by_one(h, run, window)
            assert passages.selected(h, run, window).tolist() == one
            wanted += [start + i for i in one]
            start += len(h)
        assert passages.selected(np.concatenate(hashes), run, window, np.array(list(map(len, hashes)))).tolist() == wanted


def test_one_pass_reads_lines_and_runs_of_every_text(spark, monkeypatch):
    """Each text is split once, and gives the places, digests, keys and runs that it gives alone."""
    rows = [*enumerate(TEXTS * 3), (None, TEXTS[3]), (99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for least in (20, 1):
        places, runs = reading.read(docs, least_words=least)
        folded = paragraphs.paragraphs(docs, min(5, least)).collect()
        functions = paragraphs.hash_functions()
        wanted = sorted((r.doc_id, r.para_no, bytes(r.cls), paragraphs.band_keys(r.para, 10, 3, functions)
                         if r.para.count(" ") + 1 >= least else None) for r in folded)
        assert sorted((r.doc_id, r.para_no, bytes(r.cls), r.bands) for r in places.collect()) == wanted
        alone = paragraphs.places(docs, least_words=least).collect()
        assert sorted((r.doc_id, r.para_no, bytes(r.cls), r.bands) for r in alone) == wanted
    wanted = sorted((d, *np.frombuffer(k, dtype=np.int64).tolist(), *map(int, place)) for d, t in rows if d is not None and t is not None
                    for k, *place in zip(*passages.runs_of(t)))
    assert wanted and sorted(map(tuple, runs.collect())) == wanted == sorted(map(tuple, passages.runs(docs).collect()))
    # neither is read again
    for module, name in ((paragraphs, "places"), (passages, "runs")):
        monkeypatch.setattr(module, name, None)
    lines = paragraphs.repeats(docs, found=reading.read(docs)[0])
    assert passages.passages(docs, lines, found=runs).count() > 0


def test_only_the_text_of_the_class_is_taken_where_ids_repeat(spark):
    one, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    docs = spark.createDataFrame([(1, "x\n" + one), (1, "x\n" + other.upper()), (2, other), (None, one)], "doc_id long, text string")
    at = paragraphs.places(docs).where("bands is not null and doc_id = 1").select("cls", "doc_id", "para_no")
    assert sorted(r.para for r in paragraphs.texts_of(docs, at).collect()) == [one, other]
    # lines are dealt and sorted by their place alone, not by a digest that all of them would be folded for
    plan = paragraphs.texts_of(docs, at)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"SortMergeJoin \[[^\]]*\]|hashpartitioning\([^\n]*", plan)
    assert any(k.startswith("SortMergeJoin") for k in keys) and not any("md5" in k for k in keys)


def test_the_query_compares_lines_of_any_length(spark, tmp_path):
    """Its rows of lines are those of comparing all lines of 1 to 24 words with all others."""
    rng, lines = random.Random(3), ["All rights", "Home", "one two three four", "Ω"]
    for n in range(5, 25):
        base = [f"w{n}v{i}" for i in range(n)]
        lines += [" ".join(base), " ".join([*base, "more"]), " ".join(["before", *base]), " ".join([*base[:n // 2], "x", *base[n // 2 + 1:]])]
    texts = {i + 1: "\n".join(rng.sample(lines, 12)) for i in range(16)}
    texts |= {20: "home\n \n\t\n\r", 21: " \n\nALL  rights\n\r", 22: "", 23: None, 24: "home again", None: "Home"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    at = sorted((d, i, set(paragraphs.shingle_hashes(" ".join(line.lower().split())).tolist())) for d, t in texts.items()
                if d and t for i, line in enumerate(t.split("\n")) if line.split())
    first = list(range(len(at)))
    while True:  # the least place that any chain of alike lines leads to
        seen = [min(first[j] for j, b in enumerate(at) if len(a[2] & b[2]) / len(a[2] | b[2]) >= paragraphs.SIMILARITY) for a in at]
        if seen == first:
            break
        first = seen
    wanted = [(*at[i][:2], *at[k][:2], i == k) for i, k in enumerate(first) if first.count(k) > 1]
    found = queries.op2_paragraph_dedup(spark, str(tmp_path)).where("first_word is null").drop("first_word", "n_words")
    assert len(wanted) > 100 and sorted(map(tuple, found.collect())) == wanted
