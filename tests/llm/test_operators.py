from __future__ import annotations

import hashlib
import itertools
import pathlib
import random
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tripline.llm import decontaminate, fingerprint, language, licenses, mixing, ngramjoin, sharding, suffixdedup, toxicity, urlfilter
from tripline.llm.common import components
from tests.llm import brute

random.seed(5)
VOCABULARY = ["".join(random.choices("abcdefghij", k=4)) for _ in range(300)]


def prose(n):
    return " ".join(random.choices(VOCABULARY, k=n))


def edit(text, n):
    w = text.split(" ")
    for _ in range(n):
        w[random.randrange(len(w))] = "x" + random.choice(VOCABULARY)
    return " ".join(w)


def awkward():
    """Nulls, blanks, short, long and repeated texts, a null id, exact and near copies."""
    base, long = prose(80), prose(4000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, base), (8, base), (8, base), (None, base)]
    rows += [(9, long), (10, long + " tail"), (11, "äöü ñ 漢字 " * 30), (12, "a " * 900)]
    rows += [(20 + i, edit(base, i % 4)) for i in range(30)]
    rows += [(60 + i, prose(random.choice([3, 5, 6, 40, 200]))) for i in range(40)]
    return rows


AWKWARD = awkward()


# sharding


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation_is_a_bijection_with_an_inverse(n):
    at = sharding.permute(np.arange(n), n, 3)
    assert sorted(at) == list(range(n))
    assert [sharding.row_at(int(p) % 4, int(p) // 4, n, 4, 3) for p in at[:50]] == list(range(min(n, 50)))


def test_shards_are_gapless_and_equal(frame):
    rows = sharding.shard_documents(frame(AWKWARD), 8).collect()
    assert len(rows) == len(AWKWARD)
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    texts = {(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in AWKWARD}
    assert {(r.doc_id, r.text_crc32, r.size) for r in rows} == texts


def test_shards_do_not_depend_on_partitions(frame):
    a = sharding.shard_documents(frame(AWKWARD)).collect()
    b = sharding.shard_documents(frame(AWKWARD[::-1]).repartition(7)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


# toxicity


def test_decoding_of_disguises():
    counts = np.ones((32, 32, 32))
    for word in ["idiot", "moron", "stupid", "worthless"] * 50:
        c = [0, 0, *toxicity._CLASS[np.frombuffer(f"{word} ".encode(), np.uint8)]]
        for x in zip(c, c[1:], c[2:]):
            counts[x] += 1
    model = np.log(counts / counts.sum(2, keepdims=True))
    for disguised, plain in {"1d10t": "idiot", "i d i o t": "idiot", "m0r0n": "moron", "$tup1d": "stupid", "idiooooot": "idiot", "w0rthle55": "worthless"}.items():
        assert toxicity.decode(disguised, model) == plain
    text = "You are a M0R0N, truly. Fine words stay (here); x 12 345"
    assert toxicity.restore([text, None, ""], model)[0].split() == "you are a moron truly. fine words stay (here); x 12 345".split()
    assert toxicity.restore([None, ""], model) == ["", ""]


def small_model():
    counts = np.ones((32, 32, 32))
    for word in ["idiot", "moron", "stupid", "hate", "bad"] * 50:
        c = [0, 0, *toxicity._CLASS[np.frombuffer(f"{word} ".encode(), np.uint8)]]
        for x in zip(c, c[1:], c[2:]):
            counts[x] += 1
    return np.log(counts / counts.sum(2, keepdims=True))


@pytest.mark.parametrize("text,plain", [
    ("idio7", "idiot"), ("hat3", "hate"), ("b a d", "bad"), ("i  d  i  o  t", "idiot"), ("b\n a\td", "bad"), ("b.a.d", "bad"),
    ("you idio7.", "you idiot"), ("(1diot)", "idiot"), ("mor0n!", "moron"), ("what a b4d day", "what a bad day"),
    ("great! 455 2023 v. 1,000", "great! 455 2023 v. 1,000"), ("a b", "a b"),
])
def test_every_disguise_is_met(text, plain):
    assert toxicity.restore([text], small_model())[0].split() == plain.split()


@pytest.mark.parametrize("text", ["1d10t", "b a d", "idiooot", "$7up1d", "b.4.d", "h4t3", "mmm0r0n"])
def test_decoding_takes_the_best_of_all_paths(text):
    model = small_model()
    best = None
    for path in itertools.product(*toxicity._choices(text)):
        plain = "".join(p for p, _ in path)
        c = [0, 0, *toxicity._CLASS[np.frombuffer(f"{plain} ".encode(), np.uint8)]]
        cost = sum(price for _, price in path) - sum(model[x] for x in zip(c, c[1:], c[2:]))
        best = min(best or (cost, plain), (cost, plain))
    assert toxicity.decode(text, model) == best[1]


def test_scores_match_brute_force(spark, frame):
    rows = [(i, prose(30) + (random.choice([" idiot", " 1d10t", " i d i o t"]) if i % 4 == 0 else "")) for i in range(200)] + [(900, None), (901, "")]
    labels = {i: int(i % 4 == 0) for i, _ in rows if i % 3}
    frames = frame(rows).repartition(3), spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_documents(frames[0], toxicity.train(*frames)).collect()}
    want = brute.toxicity_scores(rows, labels)
    assert got == pytest.approx(want, abs=1e-9)


def test_toxicity_learns_from_tasks_without_grams(spark, frame):
    rows = [(1, None), (2, ""), (3, "hm"), (4, "")]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(frame(rows).coalesce(1), labels)
    assert len({r.score for r in toxicity.score_documents(frame(rows), model).collect()}) == 1
    for text in ("", "a", "ab"):  # alone in a batch
        assert [len(grams) for _, _, grams, _ in toxicity._grams([text])] == [0]


def test_toxicity_learns_and_handles_awkward_rows(spark, frame):
    rows = [(1000 + i, prose(40) + (" idiot moron" if i % 5 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, int("idiot" in t)) for i, t in rows] + [(None, 1, 1), (1, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(rows), labels)
    seen = {r.doc_id: r for r in toxicity.score_documents(frame(rows + [(1, None), (2, ""), (3, "1d10t m0r0n")]), model).collect()}
    assert all(seen[i].predicted == int("idiot" in t) for i, t in rows)
    assert seen[1].score == seen[2].score < 0.5 < seen[3].score
    assert all(0 <= r.score <= 1 for r in seen.values())
    scores = toxicity.score_documents(frame(AWKWARD), model)
    assert scores.count() == len(AWKWARD)
    assert toxicity.score_documents(frame([]), model).count() == 0
    empty = toxicity.train(frame([]), labels.limit(0))
    assert {r.score for r in toxicity.score_documents(frame(AWKWARD), empty).collect()} == {0.0}


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    found = toxicity.op2_noisy_channel_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    # a twentieth of these labels is toxic without a word that tells so
    assert (found.predicted == found.toxic).mean() > 0.94
    assert found[found.predicted == 1].toxic.mean() > 0.95


# n-gram join


def test_classes_match_brute_force(frame):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngramjoin.similarity_classes(frame(AWKWARD)).collect())
    want = sorted((str(i), n, str(c)) for (i, _), (n, c) in zip(AWKWARD, brute.classes(AWKWARD)))
    assert got == want


def test_classes_of_a_large_group_of_near_copies(frame, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BLOCK", 16)
    base = prose(150)
    rows = [(i, edit(base, i % 9)) for i in range(200)] + [(500 + i, base[:200] + prose(20)) for i in range(100)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.similarity_classes(frame(rows)).collect()}
    assert got == {i: x for (i, _), x in zip(rows, brute.classes(rows))}


def test_near_duplicates_keep_one_of_each_class(frame):
    docs = frame(AWKWARD)
    kept = ngramjoin.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = sorted(str(r.doc_id) for r in kept.collect())
    want = [str(i) for (i, _), (n, _) in zip(AWKWARD, brute.classes(AWKWARD)) if n == 0]
    want += {str(c) for (_, _), (n, c) in zip(AWKWARD, brute.classes(AWKWARD)) if n}
    assert found == sorted(want)
    assert ngramjoin.drop_near_duplicates(frame([])).count() == 0


def test_ties_are_decided_by_the_other_columns(frame):
    rows = [(1, "same text of some words here", lang, source) for lang in "cab" for source in "zy"]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept = ngramjoin.drop_near_duplicates(frame(rows).repartition(4)).collect()
        assert [(r.lang, r.source) for r in kept] == [("a", "y")]


def test_components_match_union_find(spark):
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(root) if any(x in e and e[0] != e[1] for e in edges) and find(x) != x} | {
        x: x for x in got if find(x) == x
    }


# licences


def test_license_forms(spark, frame):
    known = licenses.known_digests(spark)
    rows = [
        (1, "Copyright (c) 2020 Someone\nreleased under the mit LICENCE\n"),
        (2, "Prose.\n  Licensed under the Apache Licence -- Version 2.0!\nMore. Released under the MIT License."),
        (3, None),
        (4, ""),
        (5, "Released under the MIT License. And more."),
        (6, "Released under the MIT License.\nReleased under the MIT License."),
        (6, "Released under the MIT License.\nReleased under the MIT License."),
        (None, "SPDX-License-Identifier: MIT"),
    ]
    got = list((str(r.doc_id), r.whole_license, r.notice_licenses, r.n_notices) for r in licenses.scan_licenses(frame(rows), known).collect())
    assert sorted(got, key=str) == sorted(
        [("1", "MIT", "MIT", 1), ("2", None, "Apache-2.0", 1), ("3", None, "", 0), ("4", None, "", 0), ("5", None, "", 0), ("6", None, "MIT", 2), ("6", None, "MIT", 2), ("None", "MIT", "MIT", 1)],
        key=str,
    )


def wrapped(text, width):
    """The text's lines refilled to a width, but for those that begin with a copyright mark."""
    out, held = [], []
    for line in [*text.split("\n"), ""]:
        mark = re.match(r"\W*(copyright \(c\)|copyright \[|copyright \d)", line.lower())
        if mark or not line.strip():
            out += [*textwrap.wrap(" ".join(held), width, break_long_words=False, break_on_hyphens=False), line]
            held = []
        else:
            held.append(line.strip())
    return "\n".join(out)


def test_isc_is_found_at_every_width(spark, frame):
    text = next(t for name, t in licenses.KNOWN if name == "ISC")
    usual = text.replace("above copyright", "above\ncopyright")
    rows = [(1, usual), (2, "ISC License\n\nCopyright (c) 2020, A Holder\n\n" + usual), (3, "Copyright The Foo Authors\n(c) Foo Inc\n" + text)]
    rows += [(w, f"ISC License (ISC)\nCopyright 2020 A\n\n{wrapped(text, w)}") for w in range(20, 140, 3)]
    got = licenses.scan_licenses(frame(rows), licenses.known_digests(spark)).collect()
    assert [r.doc_id for r in got if r.whole_license != "ISC"] == []


@pytest.mark.parametrize("file, name", [("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3", "LGPL-3.0"), ("MPL-2.0", "MPL-2.0"), *((None, x) for x in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "Unlicense"))])
def test_whole_licences_are_found_at_every_width(spark, frame, file, name):
    path = pathlib.Path("/usr/share/common-licenses") / (file or "")
    if not path.exists():
        pytest.skip("no licence texts here")
    texts = [path.read_text()] if file else ["The MIT License (MIT)\n\nCopyright (c) 2020 A\nAll rights reserved.\n\n" + t for x, t in licenses.TEXTS if x == name]
    rows = [(i * 1000 + w, wrapped(t, w)) for i, t in enumerate(texts) for w in (40, 60, 72, 80, 100, 9999)]
    rows += [(i * 1000, t) for i, t in enumerate(texts)]
    got = licenses.scan_licenses(frame(rows), licenses.known_digests(spark)).collect()
    assert [r.doc_id for r in got if r.whole_license != name] == []
    assert licenses.scan_licenses(frame([(1, texts[0] + "\nand more")]), licenses.known_digests(spark)).first().whole_license is None


def test_scans_of_whole_licences_equal_the_sql(spark, frame, tmp_path):
    rows = []
    texts = [t for _, t in licenses.KNOWN + licenses.TEXTS] + [p.read_text() for p in sorted(pathlib.Path("/usr/share/common-licenses").glob("*")) if p.is_file()]
    for n, text in enumerate(texts):
        for width in (9_999, 72, 40):
            paragraphs = "\n".join(textwrap.fill(x, width, break_long_words=False, break_on_hyphens=False) for x in text.split("\n"))
            rows.append((len(rows), ("MIT License\n\n" if n % 2 else "") + "Copyright (c) 2020 A. Holder\nAll rights reserved.\n\n" + paragraphs))
            rows.append((len(rows), paragraphs.upper() + " and more"))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", "copyright\nnotice", "(c) you must\n(c) 2001 X", "Copyright holders and contributors\ncopyright X", "© ©\nMIT"])]
    docs = frame(rows)
    docs.write.parquet(str(tmp_path / "documents"))
    db = duckdb.connect()
    db.sql(f"create view documents as from '{tmp_path}/documents/*.parquet'")
    got = licenses.scan_licenses(docs, licenses.known_digests(spark)).collect()
    want = db.execute(licenses.OP4_SQL).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    found = Counter(r.whole_license for r in got)
    assert all(found[name] >= 3 for name in ("MIT", "ISC", "BSD-3-Clause", "Unlicense"))
    assert not pathlib.Path("/usr/share/common-licenses/GPL-3").exists() or found["GPL-3.0"] >= 3


# url filter


def test_trie_matches_brute_force(spark):
    hosts = ["example.net", "a.example.net", "net", "notexample.net", "EXAMPLE.com", "x.org", "org", "example.net:80", ""]
    paths = ["", "/", "/en/", "/en", "/en/x", "/de/1", "/fr/", "/fr", "/x/fr/"]
    ends = ["", "?q=://a.org/fr/", "#/en/"]
    urls = [f"http://{h}{p}{e}" for h, p, e in itertools.product(hosts, paths, ends)] + [None, "", "no scheme", "://"]
    got = {r.page_id: r for r in urlfilter.judge_urls(spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")).collect()}
    for i, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m.group(1).translate(brute.LOWER), m.group(2)) if m else ("", "")
        fits = [(len(h.split(".")), len(p), h + p, v) for h, p, v in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[2:] if fits else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), url


def test_paths_with_equals_signs_match_brute_force(spark):
    paths = ["//=x", "//=", "/=", "/en//=x", "/en/=", "/fr//=a/=b", "/fr/=", "=", "/=/en/", "/==/="]
    urls = [f"http://{h}{p}" for h, p in itertools.product(["a.net", "net", "example.net", "x.org", "example.com", "="], paths)]
    got = urlfilter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert len(got) == len(urls)
    for r in got:
        fits = [(len(h.split(".")), len(p), h + p, v) for h, p, v in urlfilter.RULES if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        assert (r.rule, r.verdict) == (max(fits)[2:] if fits else (None, "allow")), urls[r.page_id]


def test_conflicting_rules_are_refused():
    with pytest.raises(ValueError):
        urlfilter.build_trie([("a.org", "/", "allow"), ("a.org", "/", "block")])


# repeated strings


@pytest.mark.parametrize("length", [16, 50, 400])
def test_repeats_match_brute_force(frame, length):
    shared = prose(200)
    rows = AWKWARD + [(200, shared + prose(9)), (201, prose(50) + shared), (202, shared[:500] + prose(3) + shared[100:900]), (203, "ab" * 700), (204, "漢字" * 300)]
    got = suffixdedup.remove_repeats(frame(rows), length).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in got)
    want = brute.without_repeats([t for _, t in rows], length)
    assert got == sorted((str(i), *w) for (i, _), w in zip(rows, want))


def test_planted_passages_go_from_400_bytes_on(spark, frame, tmp_path):
    """Passages of over 50 words in several documents: the query removes those of the contract's 400 bytes, a shorter one stays."""
    rng = random.Random(23)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    long, short = [words(n)[: 8 * n - 1] for n in (51, 60, 120)], words(52)[:399]
    assert len(long[0]) == 407 and len(short.split(" ")) == 50
    short = short.replace(" ", " a ", 3)[:399]  # of more than 50 words
    assert len(short) == 399 and len(short.split(" ")) > 50
    rows, want, marks = [], {}, iter("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    for passage in [*long, short]:
        for _ in range(3):
            # other bytes beside each copy, so that nothing longer than the passage repeats
            want[len(rows)] = len(passage) if passage != short else 0
            rows.append((len(rows), f"{words(150)} {next(marks)}{passage}{next(marks)} {words(90)}"))
    for _ in range(20):
        want[len(rows)] = 0
        rows.append((len(rows), words(200)))
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in suffixdedup.op6_bucket_refinement(spark, str(tmp_path)).collect()}
    assert {i: r.n_removed for i, r in got.items()} == want
    assert {i: r.n_spans for i, r in got.items()} == {i: int(n > 0) for i, n in want.items()}
    assert {i: r.n_bytes for i, r in got.items()} == {i: len(t) for i, t in rows}


# mixing


def test_targets_match_refilling(spark):
    sizes = [10, 0, 5000, 3, 800, 20, 60]
    names = ["a", "b", "c", "d", "é", "z", None]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()}
    want = dict(zip(names, brute.refilled(sizes, [5, 2, 1, 5, 2, 1, 5], 3.0)))
    assert got == pytest.approx(want)


def test_quotas_split_exactly():
    parts = mixing.split_quotas(np.array([100, 7, 0, 1000]), 6, 1)
    assert parts.sum(0).tolist() == [100, 7, 0, 1000] and np.ptp(parts.sum(1)) <= 1 and (parts >= 0).all()


def test_mix_meets_targets(frame):
    rows = [(i, prose(random.randrange(1, 60)), "en", random.choice(["a", "b", "c", None])) for i in range(600)] + [(900, None, "en", "a"), (901, "", "en", "empty"), (902, "x y", "en", "b"), (902, "x y", "en", "b")]
    plan = mixing.mix_plan(frame(rows)).collect()
    assert len(plan) == len(rows)
    for source in {r.source for r in plan}:
        mine = [r for r in plan if r.source == source]
        assert abs(sum(r.size * len(r.places) for r in mine) - mine[0].target) <= 30
        assert all(len(r.places) <= 3 for r in mine)
    again = mixing.mix_plan(frame(rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    drawn = mixing.draw_mix(frame(rows))
    assert drawn.count() == sum(len(r.places) for r in plan)
    assert mixing.mix_plan(frame([])).count() == 0


# language


def test_spans_and_edge_cases(spark, frame):
    de, fr = "der hund und die katze sind nicht im haus ", "le chien et la souris ne sont pas dans une maison "
    ru = "кошка и собака не в доме "
    rows = [(i, t * 3, lang) for i, (t, lang) in enumerate([(de, "de"), (fr, "fr"), (ru, "ru")] * 5)]
    model = language.train(frame(rows + [(99, "junk", None)]))
    assert model["langs"] == ["de", "fr", "ru"]
    spans = language.label_spans([de * 2 + fr * 3 + ru, ""], model)
    assert [x for x, _ in spans[0]] == ["de", "fr", "ru"] and spans[1] == []
    tests = [(1, de), (2, fr), (3, "СОБАКА"), (4, None), (5, ""), (6, "12 !? 34"), (7, de + fr * 3), (8, "漢字")]
    got = {r.doc_id: r for r in language.identify(frame(tests), model).collect()}
    assert [got[i].lang_pred for i in range(1, 8)] == ["de", "fr", "ru", "und", "und", "und", "fr"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[8].lang_pred in model["langs"]
    nothing = language.train(frame([]))
    assert {r.lang_pred for r in language.identify(frame(tests), nothing).collect()} == {"und"}
    assert language.identify(frame([]), model).count() == 0


def test_viterbi_matches_all_paths():
    scores = np.random.default_rng(1).normal(size=(14, 3)) * 3
    counts = np.array([5, 0, 3, 6])
    got, at = language.viterbi(scores, counts, 2.0), 0
    for n in counts:
        paths = itertools.product(range(3), repeat=int(n))
        value = lambda p: sum(scores[at + i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023,E731
        assert list(got[at : at + n]) == list(max(paths, key=value))
        at += n


def test_language_accuracy(spark):
    d = "/root/testdata/sf0.1"
    found = language.op8_viterbi_language(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.98


# fingerprints


def likeness(a, b, equal):
    return len(a & b) / len(a | b) if a | b else float(equal)


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_fingerprints_equal_brute_force(frame, ranges):
    # all hashes kept, so likeness is that of the shingle sets, which plain Python knows
    rows = AWKWARD + [(8, AWKWARD[7][1])] * 30 + [(300 + i, prose(1 + i % 60)) for i in range(100)]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        n = len(text) // 4
        edit = text[: len(text) - n] + following[:n]
        a, b, c = (brute.shingles(t) for t in (text, edit, following))
        near = (likeness(a, b, text == edit), likeness(a, c, text == following))
        want.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), len(a), len(b), *(round(x, 9) for x in near)))
    got = fingerprint.fingerprint_documents(frame(rows).repartition(5), scale=1, ranges=ranges).collect()
    held = [(r.doc_id, r.n_chars, r.edited_sha256, len(r.fingerprint) // 8, len(r.edited_fingerprint) // 8, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert Counter(held) == Counter(want)
    # the fixed fraction: every text, short ones too, keeps what lies below it
    whole = {r.doc_id: fingerprint.from_text(r.fingerprint) for r in got}
    for r in fingerprint.fingerprint_documents(frame(rows), ranges=ranges).collect():
        kept = whole[r.doc_id][whole[r.doc_id] < (1 << 32) // fingerprint.SCALE]
        assert fingerprint.from_text(r.fingerprint).tolist() == kept.tolist()


def test_fingerprints_of_no_row_and_one(frame):
    assert fingerprint.fingerprint_documents(frame([])).count() == 0
    one = fingerprint.fingerprint_documents(frame([(1, "abcdefgh")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_sketches_estimate_containment_and_merge():
    a, b = prose(3000), prose(2000)
    whole, part, other = fingerprint.sketches([a + " " + b, a, b])
    assert fingerprint.containment(whole, part) > 0.98
    exact = len(brute.shingles(a)) / len(brute.shingles(a + " " + b))
    assert abs(fingerprint.jaccard(whole, part) - exact) < 0.1
    assert fingerprint.containment(fingerprint.merge(part, other), whole) > 0.98
    assert list(fingerprint.from_text(fingerprint.to_text(whole))) == list(whole)


def test_likeness_is_estimated_without_bias(frame):
    rows = [(i, prose(20 + i % 300)) for i in range(300)]
    off = []
    for r in fingerprint.fingerprint_documents(frame(rows)).collect():
        text, following = rows[r.doc_id][1], rows[(r.doc_id + 1) % len(rows)][1]
        off.append(r.near_edited - likeness(brute.shingles(text), brute.shingles(fingerprint.edited(text, following)), False))
    assert abs(np.mean(off)) < 0.01 and np.abs(off).mean() < 0.05


# decontamination


def leaks(docs, items):
    out = set()
    for i, t in docs:
        words = re.findall(r"[^\W_]+", (t or "").lower())
        for j, x in items:
            item = re.findall(r"[^\W_]+", (x or "").lower())
            out |= {(i, j) for s in range(len(words) - len(item) + 1) if item and words[s : s + len(item)] == item}
    return out


def test_planted_items_are_found(spark, frame):
    items = [(j, prose(random.choice([6, 20, 45, 70]))) for j in range(12)] + [(50, None), (51, ""), (52, "zebra crossing")]
    rows = AWKWARD + [(300 + j, prose(30) + ". " + x.upper().replace(" ", ", ") + "! " + prose(20)) for j, x in items[:12]] + [(400, "A zebra crossing here."), (401, items[3][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(frame(rows), table).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.similarity == 1} >= leaks(rows, items)
    assert {r.doc_id for r in got} == {i for i, _ in leaks(rows, items)}
    kept = decontaminate.drop_leaks(frame(rows), table)
    assert kept.count() == sum(i not in {r.doc_id for r in got} for i, _ in rows)
    assert decontaminate.find_leaks(frame([]), table).count() == 0
    assert decontaminate.find_leaks(frame(rows), table.limit(0)).count() == 0


def test_hamming_blocks_hold_every_pair_within_the_radius(spark):
    a = random.getrandbits(63)
    for _ in range(50):
        b = a
        for bit in random.sample(range(63), decontaminate.RADIUS):
            b ^= 1 << bit
        row = spark.range(1).select(*(decontaminate.hamming_blocks(x).alias(n) for n, x in (("a", decontaminate.F.lit(a)), ("b", decontaminate.F.lit(b))))).first() if _ < 3 else None
        if row:
            assert any(x == y for x, y in zip(row.a, row.b))


def test_slightly_changed_items_are_found(spark, frame):
    item = prose(70)
    changed = item.split(" ")
    changed[30] = "other"
    got = decontaminate.find_leaks(frame([(1, prose(40) + " " + " ".join(changed) + " " + prose(9))]), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 7)] and 0.75 <= got[0].similarity < 1


def edited_items(items, copies):
    """Documents that hold an item with words changed, dropped, put in or its parts in another order."""
    docs = []
    for j, x in items:
        for c in range(copies):
            w = x.split(" ")
            for _ in range(c % 4):
                at = random.randrange(len(w)) if c % 8 < 4 else random.choice([0, 1, len(w) - 2, len(w) - 1])
                w[at : at + random.choice([0, 1, 1])] = random.choice([[], ["new"]])
            if c % 3 == 2:
                cut = random.randrange(len(w) // 3, len(w))
                w = w[cut:] + w[:cut]
            docs.append((1000 + len(docs), " ".join([prose(12), *w, prose(random.choice([1, 30]))])))
    return docs


def test_edited_items_match_brute_force(spark, frame):
    items = [(j, prose(random.choice([15, 20, 30, 45, 59]))) for j in range(24)]
    items += [(30, "a b " * 12 + prose(20)), (31, "the same words again " * 8)]
    docs = edited_items(items, 12) + [(1, "a b " * 40), (2, "the same words again " * 30), (3, items[3][1] + " " + items[3][1]), (4, None)]
    want = brute.similar_windows(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_leaks(frame(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert sum(v < 0.9 for v in want.values()) > 20
    assert got.keys() <= want.keys() and all(v <= want[k] + 1e-9 for k, v in got.items())
    assert len(got) >= 0.98 * len(want) and all(k in got for k, v in want.items() if v >= 0.9)


def test_results_come_through_the_fingerprints(spark, frame):
    items = [(j, prose(40)) for j in range(12)]
    docs, table = edited_items(items, 6), spark.createDataFrame(items, "item_id long, text string")
    near, all_found = (decontaminate.find_leaks(frame(docs), table, radius=r).collect() for r in (1, decontaminate.RADIUS))
    assert 0 < len(near) < len(all_found) and min(r.similarity for r in near) > 0.85


def test_items_without_an_id_and_with_one_id(spark, frame):
    items = [(None, "red green blue black white grey"), (7, "one two three four five six"), (7, "uno due tre quattro cinque sei"), (7, "one two three four five six")]
    docs = [(1, "so red green blue black white grey it is"), (2, "one two three four five six"), (3, "uno due tre quattro cinque sei sette"), (None, items[1][1])]
    got = decontaminate.find_leaks(frame(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.start_word, r.similarity) for r in got) == [("1", "None", 1, 1.0), ("2", "7", 0, 1.0), ("3", "7", 0, 1.0), ("None", "7", 0, 1.0)]
