"""Each operator on awkward rows, against plain versions, and on held-out labels."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelforge.llm import (decontamination, fertility, language, mixing, paragraphs, passages, personal_data, quality,
                            toxicity, urls)
from panelforge.llm.common import table
from panelforge.llm.components import components
from panelforge.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PROSE = "the quick brown fox jumps over the lazy dog while seven other animals watch it from a green hill nearby"
AWKWARD = [(1, None, "a", "clash"), (2, "", "a", "x"), (3, "   \n\t", None, "x"), (4, PROSE, "b", "x"),
           (4, PROSE, "b", "x"), (None, PROSE, None, None), (5, PROSE + " " + "word " * 40000, "b", "x")]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, source string, quality string")


def test_awkward_rows_pass_every_scorer(spark, awkward):
    model = language.fit([(PROSE, "en"), ("der schnelle braune Fuchs springt", "de")] * 6)
    found = language.identify(awkward, model).orderBy("doc_id").collect()
    assert len(found) == len(AWKWARD) and {r.language.language for r in found if not (r.text or "").strip()} == {"und"}
    q = quality.fit([(PROSE, 1), ("BUY!! BUY!! NOW!!", 0)] * 8)
    assert quality.classify(awkward, q).where("quality.score between 0 and 1").count() == len(AWKWARD)
    t = toxicity.fit([(PROSE, 0), (PROSE + " you blorkhead. such a blorkface", 1)] * 20)
    assert toxicity.score(awkward, t).where("toxicity.score between 0 and 1").count() == len(AWKWARD)
    judged = fertility.judge(awkward).collect()
    assert sum(r.rules.kept for r in judged) == 3 and sum(r.rules.n_words == 0 for r in judged) == 3
    p = personal_data.new_tagger()
    assert personal_data.find(awkward, p).where("size(personal.all) = 0").count() == len(AWKWARD)
    assert sorted(personal_data.redact(awkward, p).columns) == sorted(awkward.columns)
    for op in (lambda d: language.identify(d, model), lambda d: quality.classify(d, q), fertility.judge, mixing.mix):
        assert op(awkward.where("false")).count() == 0


def test_whole_words_are_read():
    model = language.fit([("abcabcabc " * 5, "x"), ("xyzxyz zyx " * 5, "y")] * 12)
    reader = language.Reader(model)
    short, long = "abc" * 14, "abc" * 14 + "xyz" * 60_000
    z, y = reader.logits(short), reader.logits(long)
    assert model.languages[int(z.argmax())] == "x" and model.languages[int(y.argmax())] == "y"
    ids = language.subwords(long, language.Buckets())
    assert len(ids) == 1 + 3 * (len(long) + 2) - 6
    whole = model.bucket_logits()[ids].mean(axis=0) + model.bias
    assert abs(whole - y).max() < 1e-6
    assert quality.shape("a" * 70 + "!") == "a!" and quality.shape("0-" * 9 + "X") == "0-A" and quality.shape("Word!!") == "Aa!"


def test_mixing_reaches_the_weights_and_keeps_nulls_apart(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x" * 50).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "rare").alias("source"))
    got = {r.source: r.n for r in mixing.mix(docs, {"hot": 1.0, "rare": 3.0}).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {"hot", "rare"} and 0.85 < got["rare"] / 3000 < 1.15 and 0.85 < got["hot"] / 1000 < 1.15
    assert mixing.mix(docs).where("source is null").count() > 1000
    heavy = mixing.mix(docs.limit(50).unionByName(docs.where("source = 'rare'")), {"hot": 1.0})
    assert heavy.groupBy("doc_id").count().agg(F.max("count")).first()[0] > 20  # a mean above PART


def plain_hits(docs, items, n=13):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    out = {}
    for key, text in docs:
        w, hit, who = re.findall(pattern, (text or "").lower()), set(), set()
        for item, t in items:
            iw = re.findall(pattern, (t or "").lower())
            for s in range(max(1, len(iw) - n + 1) if iw else 0):
                win = iw[s:s + n]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        who.add(item)
        out[key] = (len(w), len(hit), sorted(who))
    return out


def test_decontamination_is_the_plain_one(spark):
    long = " ".join(f"w{i % 29}" for i in range(60))
    items = [(1, long), (2, "short item"), (3, None), (4, ""), (2, "another text entirely"), (5, "w1 w2 w3")]
    docs = [(1, f"x {long} y"), (2, "a SHORT, item here and short item"), (3, None), (4, ""), (5, "w1 w2 w3 w4"),
            (6, " ".join(long.split()[:12])), (7, " ".join(long.split()[5:30]) + " another text entirely"), (8, "q " * 50 + "short item")]
    found = decontamination.decontaminate(spark.createDataFrame(docs, "doc_id long, text string").withColumn("hits", F.lit(1)),
                                          spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.hits.n_words, r.hits.n_hit, sorted(r.hits["items"])) for r in found.collect()}
    assert got == plain_hits(docs, items)
    near = decontamination.proximity(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string"))
    assert {(2, 2), (1, 1)} <= {(r.doc_id, r.item_id) for r in near.collect()}


def test_windows_and_measures_are_the_plain_ones():
    import random
    rng = random.Random(1)
    for _ in range(60):
        words = rng.choices("abcd", k=rng.randint(0, 40))
        wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(5)}
        assert fertility.repeated_words(words) == len(covered)
    with open(fertility.VOCABULARY, "rb") as f:
        v = f.read()
    text = (PROSE + ".\n") * 3000
    whole = len(fertility.encoder(v)[0].encode_ordinary(text))
    assert fertility.measure(text, v)[5] == whole and fertility.duplicate_lines("a\n \na\nb") == 1
    assert fertility.measure(None, v)[:6] == (0, 0, 0, 0, 0, 0) and fertility.script("Ωμέγα abc") == "GREEK"


def test_bands_reject_what_the_base_lets_through(spark):
    found = QUERIES["op5_tokeniser_fertility"](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("not base_failed")
    got = {r.quality: (r.n, r.rejected) for r in found.groupBy("quality").agg(
        F.count("*").alias("n"), F.avg((~F.col("in_band")).cast("int")).alias("rejected")).collect()}
    assert got[0][1] >= 0.6 and got[1][1] <= 0.04, got
    rng = random.Random(3)
    words = PROSE.split() + "time year people way day man thing woman life child world school state family student".split()
    clean = [(i, " ".join(rng.choices(words, k=rng.randint(60, 120))).capitalize()) for i in range(300)]
    junk = [(1000 + i, text.upper()) for i, text in clean[:6]]  # upper case only: nothing that the base counts
    rows = fertility.judge(spark.createDataFrame(clean + junk, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if not r.rules.base_failed and not r.rules.kept} >= {k for k, _ in junk}
    assert sum(r.rules.kept for r in rows if r.doc_id < 1000) >= 295


def plain_spans(text):
    n = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(n(m.group())) <= 19 and personal_data.luhn(n(m.group()))]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= len(n(m.group())) <= 15]


def test_base_spans_are_the_plain_ones():
    import random
    rng = random.Random(5)
    parts = ["a", "@", ".", "b.c", "1", "23", " ", "-", "+1", "(5", ") ", "4111111111111111", "255", "300", "é", "\n", "1.2.3.4"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert personal_data.base_spans(text) == plain_spans(text), text
    assert personal_data.masked("me a@b.cd 1.2.3.4", [("email", 3, 9), ("ip", 10, 17)]) == "me [EMAIL] [IP]"


def test_gradient_of_the_tagger():
    import numpy as np
    rng = np.random.default_rng(0)
    model = personal_data.new_tagger()
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    x, y = rng.integers(0, 99, (9, 3)), rng.integers(0, 6, (9, 3))
    _, grad = personal_data.gradients(model, x, y)
    for k, at in (("t", (1, 2)), ("w", (3, 1)), ("uf", (2, 5)), ("ub", (1, 40)), ("xf", (int(x[4, 0]), 7)), ("c", (2,))):
        old = model.params[k][at]
        losses = []
        for d in (1e-3, -1e-3):
            model.params[k][at] = old + d
            losses.append(personal_data.gradients(model, x, y)[0])
        model.params[k][at] = old
        assert abs((losses[0] - losses[1]) / 2e-3 - grad[k][at]) < 1e-3


def test_colliding_digests_are_told_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(urls, "digest", lambda key: len(key) % 3)
    urls.write_array([("a.com", 2), ("b.org", 2), ("com/x", 1)], str(tmp_path / "d"))
    array = urls.DigestArray(str(tmp_path / "d"))
    assert array.kinds_of(["a.com", "c.net", "b.org", "com/x"]) == [[2], [], [2], [1]]
    assert urls.split_url("HTTP://Ab.C:80?q/x") == ("ab.c:80", "") and urls.split_url(None) == ("", "")
    assert urls.split_url("x://h/p?q#f") == ("h", "/p")


def test_repeated_paragraphs(spark):
    a = " ".join(f"w{i}" for i in range(60))
    near = a.replace("w30", "other")
    rows = [(1, f"intro\n{a}"), (2, f"{a.upper()}\nend"), (3, near), (4, "short line\nshort line"), (5, None), (6, " ".join(f"z{i}" for i in range(60)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = paragraphs.repeats(docs)
    assert sorted((r.doc_id, r.para_no, r.first_doc_id, r.kept) for r in found.collect()) == [
        (1, 1, 1, True), (2, 0, 1, False), (3, 0, 1, False)]
    left = {r.doc_id: r.text for r in paragraphs.remove_repeats(docs, found).collect()}
    assert left[2] == "end" and left[3] == "" and left[1] == rows[0][1] and left[5] is None
    assert paragraphs.repeats(docs.where("false")).count() == 0


def test_paragraphs_of_awkward_rows(spark, awkward):
    """NULL, empty and very long texts, repeated rows, NULL ids and clashing column names."""
    docs = awkward.selectExpr("doc_id", "text", "source as cls", "quality as key", "source as para", "1 as n")
    found = [tuple(r) for r in paragraphs.repeats(docs.unionByName(docs.selectExpr(
        "doc_id + 10 as doc_id", "text", "cls", "key", "para", "n"))).collect()]
    assert sorted(found) == [(4, 0, 4, 0, True), (5, 0, 5, 0, True), (14, 0, 4, 0, False), (15, 0, 5, 0, False)]


def test_equal_short_lines(spark):
    rows = [(1, "All rights reserved by the authors\nHome"), (2, "x\n all  RIGHTS reserved by the authors\nHome"), (3, "all rights kept by the authors")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, paragraphs.repeats(docs).collect())) == [(1, 0, 1, 0, True), (2, 1, 1, 0, False)]
    few = PROSE.rsplit(" ", 2)[0]  # 18 words, one edited: no copy, as it isn't equal
    assert paragraphs.repeats(spark.createDataFrame([(1, few), (2, few.replace("fox", "cat")), (3, few)], docs.schema)).count() == 2


def test_passages_inside_long_and_wrapped_lines(spark):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    same = words("s", 60).split()
    wrapped = "\n".join(" ".join(same[i:i + 9]) for i in range(0, 60, 9))
    rows = [(1, words("a", 200) + " " + " ".join(same) + " " + words("b", 240)), (2, words("c", 30) + "\n" + wrapped),
            (3, f"x\n{words('d', 90)} {' '.join(same).upper()} {words('e', 7)}"), (4, words("f", 400)), (5, None), (6, ""), (None, wrapped),
            (7, "word " * 3000), (8, "word " * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in paragraphs.repeats(docs).collect()} & {1, 2, 3} == set()
    found = {r.doc_id: r for r in passages.passages(docs).collect()}
    assert {k: (r.para_no, r.first_doc_id, r.first_para_no, r.kept) for k, r in found.items()} == {
        1: (0, 1, 0, True), 2: (found[2].para_no, 1, 0, False), 3: (1, 1, 0, False), 7: (0, 7, 0, True), 8: (0, 7, 0, False)}
    start = {1: 200, 2: 30, 3: 91}
    for k, at in start.items():  # within the passage, and all of it but 12 words at an end
        assert at <= found[k].first_word <= at + 12 and at + 60 - 12 <= found[k].first_word + found[k].n_words <= at + 60
    assert passages.passages(docs.where("false")).count() == 0


def test_any_shared_run_of_38_words_is_selected_alike():
    rng = random.Random(9)
    for _ in range(200):
        shared = [rng.randrange(50) for _ in range(38)]
        sides = [" ".join(map(str, [rng.randrange(50) for _ in range(rng.randrange(60))] + shared + [rng.randrange(50) for _ in range(rng.randrange(60))]))
                 for _ in range(2)]
        assert set(passages.runs_of(sides[0])[0]) & set(passages.runs_of(sides[1])[0])


def test_matches_of_a_large_band_are_those_of_brute_force(spark):
    """Families of edited copies, most of them too far from each other, in one band."""
    rng, base = random.Random(5), [[f"b{k}w{i}" for i in range(48)] for k in range(2)]
    texts = set()
    for k in range(2):
        for _ in range(150):
            words = list(base[k])
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                i = rng.randrange(len(words))
                words[i:i + 1] = rng.choice([[], [f"n{rng.randrange(400)}"], [words[i], f"n{rng.randrange(4)}"]])
            texts.add(" ".join(words))
    texts = sorted(texts)
    sets = [set(paragraphs.shingle_hashes(t).tolist()) for t in texts]
    reach = list(range(len(texts)))

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) / len(a | sets[j]) >= 0.8:
                reach[max(root(i), root(j))] = min(root(i), root(j))
    frame = spark.createDataFrame([(1, bytes([i // 256, i % 256]), len(texts), t) for i, t in enumerate(texts)],
                                  "key long, cls binary, n long, para string")
    edges = paragraphs.matches(frame.drop("para"), frame.select("cls", "para"), 0.8)
    group = {r.node: r.component for r in components(edges).collect()}
    name = lambda i: bytes([i // 256, i % 256])
    assert [group.get(name(i), name(i)) for i in range(len(texts))] == [name(root(i)) for i in range(len(texts))]
    assert edges.distinct().count() < len(texts) * 8


def test_grammar_weighs_how_a_word_is_used():
    model = toxicity.ToxicityModel({"blork": 3.0})
    read = lambda t: toxicity.Reader(model).read(t).tolist()
    used = lambda t: [toxicity.EMISSIONS[i] for i, v in enumerate(read(t)) if v > 0]
    assert used("what a blorkhead") == ["insult"] and used("you are a blorkhead") == ["insult at target"]
    assert used("you are not a blorkhead") == ["negated insult"] and used("he said: fine. the blorkhead") == ["insult"]
    assert used("it said blorkhead") == ["reported insult"] and used("i will kill you") == ["threat at target"]


@pytest.mark.parametrize("name, label, least", [("op10_quality", "quality", 0.95), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_labels(spark, name, label, least):
    scored = QUERIES[name](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out")
    right = scored.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    assert right >= least


def test_held_out_languages(spark):
    found = QUERIES["op1_language_id"](spark, SF).join(table(spark, SF, "documents"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.97


def test_pipeline(spark):
    small = "/root/testdata/sf0.001"
    docs = table(spark, small, "documents")
    out = corpus_pipeline.run(spark, small)
    assert set(docs.columns) <= set(out.columns) and out.count() > 0
    assert out.join(docs, "doc_id", "left_anti").count() == 0
    assert out.where(F.col("text").rlike(r"@mail\d")).count() == 0
