"""Operators on single texts against the library, plain regular expressions and held-out labels."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F
from treelens.llm import bpe_codec, decontamination, pii, quality, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts():
    rng = random.Random(2)
    alphabet = [*"abst'rdmvle  \n\t'!?.,12é漢𝒳😀\x1c\x85\r_%", "<|endoftext|>", "'s", "'re", "'ll", "  ", "\n\n"]
    mixed = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return [None, "", " ", "x" * 20000, "ab" * 3000, "<|endoftext|>" * 3, "<|endoftext", *mixed]


def test_tokens_and_round_trip_equal_the_library(make):
    from tokenizers import Tokenizer

    tokenizer, values = Tokenizer.from_file(PATH), texts()
    counted = {r.doc_id: r for r in token_counts.with_token_counts(make(values), PATH).collect()}
    coded = {r.doc_id: r for r in bpe_codec.round_trip(make(values), PATH).collect()}
    whole = {r.doc_id: r.ids for r in bpe_codec.encode(make(values), PATH).collect()}
    for i, text in enumerate(values):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert whole[i] == ids
        assert (counted[i].n_tokens, counted[i].n_bytes, counted[i].over_limit) == (len(ids), len((text or "").encode()), len(ids) > 512)
        assert coded[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert coded[i].decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    digits = re.sub("[^0-9]", "", value)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 13 <= len(digits) <= 19 and luhn


def test_base_spans_equal_plain_patterns(make):
    rng = random.Random(3)
    alphabet = [*"ab1234567890..--  +()@@_%é😀\n", "4111 1111 1111 1111", "1.2.3.4", "a@b.co", "+1 (377) 555-0271", "255."]
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    values += [None, "", "a@b.co_x@y.zz", "1.2.3.4.5.6.7.8", "0" * 20000, "a" * 20000 + "@", "1 " * 9000, "x@y" + ".z" * 9000]
    got = {r.doc_id: r for r in pii.find_personal_data(make(values)).collect()}
    for i, text in enumerate(values):
        want = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]
        assert [(pii.KINDS[s.kind], s.start, s.end) for s in got[i].base] == want
        assert {tuple(s) for s in got[i].base} <= {tuple(s) for s in got[i].spans}


def test_very_many_matches_in_one_text(make):
    """Cost grows with the matches; loose spans beside as many base spans."""
    n = 20_000
    text = " ".join(f"a{i}@b.cc 10.0.{i % 256}.{i % 99} x" for i in range(n))
    begin = time.time()
    row = pii.find_personal_data(make([text, "a@b.cc"])).orderBy("doc_id").first()
    assert time.time() - begin < 60
    want = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m.group())]
    assert len(want) >= 2 * n and [(pii.KINDS[s.kind], s.start, s.end) for s in row.base] == want


def test_no_candidates_at_all(make):
    assert [tuple(r) for r in pii.find_personal_data(make(["plain", None])).select("base", "spans").collect()] == [([], [])] * 2


def test_reliabilities_follow_agreement():
    belief = pii.estimate({(0, 1, 1, 0, 1): 50, (0, -1, -1, 0, -1): 50, (0, 1, 1, 0, -1): 5})
    assert belief[0, 1, 1, 0, 1] > 0.9 and belief[0, -1, -1, 0, -1] < 0.1


def test_decontamination_short_items_nulls_and_clashes(spark, make):
    run = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"
    items = [(1, run), (2, "Only, three words"), (3, ""), (None, "q1 q2"), (10, run), (10, run)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    values = [None, "", f"x {run.upper()} y", "w1 w2 w3 w4 w5 w6 w7 w8 w9", "only three words only three words", "q1-q2", "clean"]
    got = {r.doc_id: r for r in decontamination.contamination(make(values), bench).collect()}
    assert [got[i].n_hit for i in range(7)] == [0, 0, 12, 0, 6, 2, 0]
    assert [got[i].items for i in range(7)] == [[], [], ["1", "10"], [], ["2"], [], []]
    assert [(s.start, s.end) for s in got[2].hits] == [(1, 13)]
    assert decontamination.contamination(make([]).limit(0), bench).count() == 0
    assert decontamination.contamination(make(values), bench.limit(0)).filter("n_hit > 0").count() == 0


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = toxicity.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out and toxic is not null")
    told = rows.selectExpr("avg(cast(predicted = toxic as double)) as a", "avg(case when toxic = 1 then score end) as t", "avg(case when toxic = 0 then score end) as c").first()
    assert told.a > 0.95 and told.t > 0.7 and told.c < 0.05


def test_toxicity_locates_sentences_and_takes_empty_input(spark, make):
    rng = random.Random(1)
    calm = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    values = [" ".join(rng.choice(calm) for _ in range(6)) + ". " + " ".join(rng.choice(calm) for _ in range(4)) + (" vile é." if i % 3 == 0 else ".") for i in range(300)]
    docs = make(values + [None, "", "..."])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(0, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].predicted == (i % 3 == 0) for i in range(300))
    assert [got[i].score for i in (300, 301, 302)] == [0.0] * 3
    assert values[0][got[0].sentences[0].start : got[0].sentences[0].end].endswith("vile é")
    none = toxicity.train(docs, labels.limit(0))
    assert toxicity.score(docs, none).filter("predicted = 1").count() == 0


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.op3_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    told = rows.selectExpr("avg(cast(cast(kept as int) = quality as double)) as a").first()
    assert told.a > 0.97


def graded(words, count, seed):
    """Different texts that share some words."""
    rng = random.Random(seed)
    return [" ".join([*words, *("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(4))]) for _ in range(count)]


def test_quality_edges(spark, make):
    docs = make([None, "", "one two"] + graded(["good", "text", "here"], 60, 1) + graded(["###", "##"], 60, 2))
    grades = spark.createDataFrame([(i, 2 if i < 63 else 0) for i in range(3, 123)] + [(1, None), (2, 9)], "doc_id long, grade int")
    clash = docs.withColumn("expected_grade", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("tail_probability", F.lit(None).cast("string"))
    model = quality.train(clash, grades, 3)
    got = {r.doc_id: r for r in quality.rate(clash, model).collect()}
    assert list(model.thresholds) == sorted(model.thresholds) and got[5].kept and not got[80].kept
    assert got[0].expected_grade == got[1].expected_grade
    assert quality.rate(docs, quality.train(docs, grades.limit(0), 3)).count() == 123
    assert quality.rate(make([]), model).count() == 0 and quality.train(make([]), grades, 3).weight.max() == 0


def test_quality_predicts_the_middle_grade(spark, make):
    kinds = [["###", "##"], ["fair", "plain"], ["good", "text"]]
    texts = [t for i, k in enumerate(kinds) for t in graded(k, 120, i)]
    docs = make(texts)
    grades = spark.createDataFrame([(i, i // 120) for i in range(360)], "doc_id long, grade int")
    rows = quality.rate(docs, quality.train(docs, grades, 3), keep_from=2).collect()
    assert all(round(r.expected_grade) == r.doc_id // 120 for r in rows)
    assert all(r.kept == (r.doc_id >= 240) for r in rows)
