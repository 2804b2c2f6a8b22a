"""Kept ids and texts of every pipeline stage against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
from test_pairs import distance, fingerprint, roots
from treelens.llm import lines


def corpus():
    """(documents, toxic ids, benchmark items)"""
    rng = random.Random(41)
    calm = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(80)]
    some = lambda n: " ".join(rng.choice(calm) for _ in range(n))
    items = [some(12), some(15), "only three words"]
    texts, toxic = {}, set()
    for i in range(300):
        own = [some(12) for _ in range(3)]
        if i % 11 == 5:
            words = rng.choice(rng.choice(list(texts.values())).split("\n")[:2]).split(" ")
            words[rng.randrange(len(words))] = "changed"
            own[1] = " ".join(words)
        if i % 13 == 6:
            own[2] += " " + items[0].upper() + " " + some(4)
        if i % 17 == 7:
            own[0] += " " + " ".join(items[1].split(" ")[2 : 11 + i % 2]) + " " + some(9)
        if i % 3 == 0:
            toxic.add(i)
            own[2] += ". " + some(3) + " vile."
        texts[i] = "\n".join(own)
    for i in range(300, 320):  # whole copies
        texts[i] = texts[rng.choice([j for j in range(300) if j not in toxic])]
    base = [" ".join(rng.choice(["!", "??", "...", "-"]) * rng.randint(1, 3) for _ in range(200)) for _ in range(3)]
    for i in range(320, 340):  # lines without words: line dedup leaves them, SimHash does not
        w = base[i % 3].split(" ")
        if i % 2:
            w[rng.randrange(200)] = "="
        texts[i] = " ".join(w)
    texts[340] = "here are only THREE words, really"
    return texts, toxic, items


def without_lines(texts):
    spots = [(d, n, p) for d in sorted(texts) for n, x in enumerate(texts[d].split("\n")) if (p := lines.normalise(x.encode()))]
    plain = sorted({p for *_, p in spots})
    split = [p.split() for p in plain]
    count = [Counter(w) for w in split]
    links = []
    for a in range(len(plain)):
        for b in range(a):
            longer = max(len(split[a]), len(split[b]))
            if (count[a] & count[b]).total() >= 0.8 * longer - 1e-9 and distance(split[a], split[b]) <= int(longer * 0.2 + 1e-9):
                links.append((a, b))
    assert len(links) > 5
    group, seen, gone = dict(zip(plain, roots(len(plain), links))), set(), defaultdict(set)
    for d, n, p in spots:
        if group[p] in seen:
            gone[d].add(n)
        seen.add(group[p])
    return {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d]) for d, t in texts.items()}


def first_of_components(texts):
    ids = sorted(texts)
    prints = [fingerprint(texts[i]) for i in ids]
    links = [(a, b) for a in range(len(ids)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 4]
    return {i: texts[i] for i, root in zip(ids, roots(len(ids), links)) if ids[root] == i}


def uncontaminated(texts, items):
    split = lambda text: re.findall("[a-z0-9]+", text.lower())
    windows = {tuple(w[p : p + 10]) for w in map(split, items) for p in range(max(1, len(w) - 9))}
    hit = lambda w: any(tuple(w[p : p + n]) in windows for n in {len(x) for x in windows} for p in range(len(w) - n + 1))
    return {i: t for i, t in texts.items() if not hit(split(t))}


def test_stages_keep_what_plain_python_keeps(spark, tmp_path):
    texts, toxic, items = corpus()
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in texts], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    models = {
        "toxicity": lambda kept: {i: t for i, t in kept.items() if i not in toxic},
        "line_dedup": without_lines,
        "simhash_near_dedup": first_of_components,
        "benchmark_decontamination": lambda kept: uncontaminated(kept, items),
    }
    docs, want = spark.read.parquet(f"{tmp_path}/documents.parquet"), texts
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, want = want, models[name](want)
        assert want != before, name
        docs = stage(spark, docs, str(tmp_path)).cache()
        got = docs.collect()
        assert len(got) == len(want), name
        assert {r.doc_id: r.text for r in got} == want, name
        assert all(r.n_chars == len(r.text) for r in got)
    coded = corpus_pipeline.run(spark, str(tmp_path)).collect()
    digests = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert len(coded) == len(want) and {r.doc_id: r.decoded_sha256 for r in coded} == digests
