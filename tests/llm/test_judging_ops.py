"""Quality rules, benchmark passages, licenses, the pipeline."""

import hashlib
import zlib

import pytest

from voxledger.llm import decontamination, license_scan, quality


def auc(rows):
    good, bad = ([s for y, s in rows if y == k] for k in (1, 0))
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


@pytest.fixture(scope="module")
def sf1():
    return "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark, sf1):
    from voxledger.llm.catalog import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, sf1).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf1}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    held = [(y, rows[i].score) for i, y in labels.items() if rows[i].held_out]
    assert auc(held) > 0.95
    assert all(s >= 0.3 for y, s in held if y == 1)  # good documents stay


def test_rules_as_columns(spark):
    from pyspark.sql import functions as F

    model = quality.RuleModel(-1.0, (((("words", True, 2.0), ("upper", False, 0.5)), 3.0),))
    df = spark.createDataFrame([(1, "a b c"), (2, "A B C"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: round(r.score, 6) for r in quality.with_scores(df, model).collect()}
    assert got == {1: round(1 / (1 + 2.718281828459045 ** -2), 6), 2: round(1 / (1 + 2.718281828459045), 6), 3: round(1 / (1 + 2.718281828459045), 6)}
    assert quality.simplified((("a", True, 1.0), ("b", False, 3.0), ("a", True, 2.0), ("b", False, 4.0))) == (("a", True, 2.0), ("b", False, 3.0))
    assert df.select(F.lit(1)).count() == 3


def test_quality_odd_rows(odd, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit_rules(odd, none)
    assert model.weights == () and model.intercept == 0
    one = quality.fit_rules(odd, spark.createDataFrame([(1, 1), (3, 1), (None, 0), (7, None)], "doc_id long, quality int"))
    assert one.weights == () and one.intercept > 0
    out = quality.with_scores(odd, model)
    assert out.columns[:3] == ["doc_id", "text", "lang"] and out.count() == odd.count() and {r.score for r in out.collect()} == {0.5}
    assert quality.keep_good(odd, none).columns == odd.columns and quality.keep_good(empty, none).count() == 0


# --- benchmark passages

ITEM = "Tom has 3 apples and Ann gives Tom 5 more apples so how many kg does Tom have now in total"


def judge(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: (r.contaminated, list(r.item_ids), r.reparameterised) for r in decontamination.contaminated(docs, bench).collect()}


def test_other_parameters_are_found(spark):
    got = judge(spark, [
        "well. " + ITEM + ". ok", ITEM.upper(), "Bob has 7 apples and Eve gives Bob 9 more apples so how many lb does Bob have now in total.",
        "Bob has 7 apples and Eve gives Max 9 more apples so how many lb does Sam have now in total", "apples and apples so how many", "", None])
    assert got[0] == (True, [0], False) and got[2] == (True, [0], True)
    assert [got[k][0] for k in (3, 4, 5, 6)] == [False] * 4  # slots that clash, chance overlap, nothing


def test_copies_in_any_case(spark):
    other = "Bob has 7 apples and Eve gives Bob 9 more apples so how many kg does Bob have now in total"
    got = judge(spark, [ITEM.upper(), ITEM.lower(), ITEM.title(), "so: " + ITEM.swapcase() + ".", ITEM, other.lower(), ITEM.lower()[:40]])
    assert [got[k] for k in range(5)] == [(True, [0], False)] * 5
    assert not got[5][0] and not got[6][0]  # in lower case other names are other words


def test_items_of_few_literal_words(spark):
    items = ["What Is The Capital Of France", "Anna Ben Carla David Emil Frida Georg Hanna Ida Jonas", "2 3 5 7 11 13 17 19 23", "Pi Day", "", None,
             "Anna has 3 red apples and 4 green pears Anna Ben Carla David Emil Frida Georg Hanna Ida Jonas Kai Lea Max Nora Otto Paul"]
    texts = ["so: " + t + ". ok" for t in items[:4]] + [t.lower() for t in items[:4]]
    texts += ["What Is The Capital Of Spain", "Anna Ben Carla David Max Frida Georg Hanna Ida Jonas", "2 3 5 7 12 13 17 19 23", "pi and day", "",
              "Bob has 7 red apples and 9 green pears Bob Yan Xia", items[6].upper()]
    got = judge(spark, texts, items)
    assert [got[k] for k in range(8)] == [(True, [k % 4], False) for k in range(4)] * 2
    assert not any(got[k][0] for k in range(8, 13))
    assert got[13] == (True, [6], True)  # its typed windows decide on other names
    assert got[14][1] == [1, 6]


def test_planted_passages(spark, sf1):
    from voxledger.llm.catalog import QUERIES

    plain = lambda t: " " + " ".join((t or "").split()) + " "
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{sf1}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf1}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op7_decontamination"](spark, sf1).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        whole = [i for i, t in items if t in plain(d.text)]
        planted += bool(whole)
        assert set(whole) <= set(got[d.doc_id].item_ids)
        if got[d.doc_id].contaminated and not whole:  # an edited passage: still thirteen words in a row of it
            words = {tuple(plain(d.text).lower().split()[k:k + 8]) for k in range(len(d.text.split()) - 7)}
            item = next(t for i, t in items if i == got[d.doc_id].item_ids[0]).lower().split()
            assert any(tuple(item[k:k + 8]) in words for k in range(len(item) - 7))
    assert planted > 10


def test_decontamination_odd_rows(odd, empty, spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "a b"), (None, ITEM), (1, ITEM)], "item_id long, text string")
    assert decontamination.contaminated(odd, bench).count() == odd.count()
    assert decontamination.contaminated(empty, bench).count() == 0
    rows = decontamination.contaminated(odd, bench.limit(0)).collect()
    assert len(rows) == odd.count() and not any(r.contaminated for r in rows)
    assert decontamination.drop_contaminated(odd, bench).columns == odd.columns


# --- licenses

LINES = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "All rights reserved.": "All-rights-reserved",
         "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
         "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}


def test_license_lines_of_the_table(spark, sf1):
    from voxledger.llm.catalog import QUERIES

    got = {r.doc_id: set(r.licenses.split(",")) - {""} for r in QUERIES["op5_license_scan"](spark, sf1).collect()}
    found = 0
    for d in spark.read.parquet(f"{sf1}/documents.parquet").collect():
        want = {v for k, v in LINES.items() if k in d.text}
        found += len(want)
        assert got[d.doc_id] == want
    assert found > 10


def test_wording_decides():
    t = license_scan.Templates()
    names = lambda text: [(f["license"], f["differences"]) for f in t.scan(text)[1]]
    assert names("Licensed under the Apache License, Version 1.1.") == []
    assert names("This work is licenced under GNU General Public License version 3") == [("GPL-3.0", ["-licensed +licenced", "-the +"])]
    assert names("a license to kill") == [] and names("") == []
    mit = license_scan.TEMPLATES[1][1].replace(" of ", "\nof ")
    assert names("before\n" + mit + "\nafter") == [("MIT", [])]
    assert names("x " * 40_000 + "\nAll rights reserved.\n" + "y " * 40_000) == [("All-rights-reserved", [])]


@pytest.mark.parametrize("between", ["\n", " ", "\nsee below\n"])
def test_every_notice_of_a_block(between):
    t = license_scan.Templates()
    two = between.join(["Released under the MIT License.", "Licensed under CC BY 4.0."])
    assert [f["license"] for f in t.scan(two)[1]] == ["MIT", "CC-BY-4.0"]
    three = between.join(["Released under MIT License.", "Licensed under the Apache License, Version 2.0.", "All rights reserved."])
    n, found = t.scan(three)
    assert n == 1 and [(f["license"], f["differences"]) for f in found] == [("MIT", ["-the +"]), ("Apache-2.0", []), ("All-rights-reserved", [])]
    assert three[found[1]["start"]:found[1]["end"]] == "Licensed under the Apache License, Version 2.0"
    long = license_scan.TEMPLATES[3][1]  # holds a shorter template
    assert [f["end"] - f["start"] for f in t.scan(between.join([long, long]))[1]] == [len(long) - 1] * 2


def test_text_around_hides_no_notice():
    t = license_scan.Templates()
    names = lambda text: [f["license"] for f in t.scan(text)[1]]
    prose = [hashlib.sha256(b"%d" % k).hexdigest()[:3 + k % 7] for k in range(600)]
    for name, wording in license_scan.TEMPLATES:
        for n in (0, 5, 10, 40, 150, 600):
            around = " ".join(prose[:n])
            assert names(f"{around} {wording}") == names(f"{wording} {around}") == names(f"{around} {wording} {around}") == [name]
        parts = wording.split(" ")
        for k in range(1, len(parts)):  # broken over lines anywhere, behind other lines
            text = "\n".join([*prose[:9], " ".join(parts[:k]), " ".join(parts[k:]), *prose[:9]])
            assert names(text) == [name], text
    deep = ["first w%d" % k for k in range(80)] + ["copyright holds"]  # a template that goes far beyond the usual reach
    deep = "\n".join(x + " " * 60 for x in deep)
    assert [f["license"] for f in license_scan.Templates([("Deep", deep)]).scan("so\n" + deep)[1]] == ["Deep"]


def test_license_odd_rows(odd, empty):
    assert license_scan.scan_licenses(odd).count() == odd.count() and license_scan.scan_licenses(empty).count() == 0


# --- pipeline

def test_pipeline_stages(spark, sf):
    """Every stage on its own input, beside plain Python versions."""
    import corpus_pipeline
    from tests.llm.test_text_ops import brute_components, brute_exact, library, word_sets
    from public_tokenizers import path

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    texts = lambda df: {r.doc_id: r.text or "" for r in df.collect()}

    good = stage["quality"](spark, docs, sf).cache()
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = set(texts(good))
    assert all(i in kept for i, y in labels.items() if y == 1)
    assert sum(i not in kept for i, y in labels.items() if y == 0) >= 0.8 * sum(y == 0 for y in labels.values())

    once = stage["exact_dedup"](spark, good, sf).cache()
    assert once.columns == docs.columns and set(texts(once)) == {i for i, x in brute_exact(texts(good).items()).items() if x[2]}

    near = stage["near_dedup"](spark, once, sf).cache()
    groups = brute_components(word_sets(texts(once).items()))
    assert near.columns == docs.columns and set(texts(near)) == set(groups.values())

    clean = stage["decontamination"](spark, near, sf).cache()
    bench = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = {i for i, t in texts(near).items() if any(b in " ".join(t.split()) for b in bench)}
    assert clean.columns == docs.columns and not holds & set(texts(clean)) and len(texts(clean)) >= len(texts(near)) - len(holds) - 2

    tokens, left = stage["tokens"](spark, clean, sf).collect(), texts(clean)
    for r in tokens[:40]:
        ids, back = library(path("byte_bpe_50k.json"), left[r.doc_id])
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(back.encode()).hexdigest())
    assert {r.doc_id for r in tokens} == set(left)


def test_pipeline_run(spark, sf):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, sf).collect()
    assert 50 < len(rows) < 200 and len({r.doc_id for r in rows}) == len(rows)


def test_windows_equal_plain_python(spark):
    """One split gives the words and template of plain Python, and the shifted columns every window."""
    import regex

    text = "Ünder 5 km/h, $3.50 €20-30 12kg; Bob's Élan x  7\tmiles «Zu» McDonald 5% a\u0085b £3 9 % and 7 km Abc 4 cents"
    texts = [text, "", None, " \n ", "one two 3 km", text + " " + text, "a " * 20]

    def plain(t):
        out, before = [], ""
        for w in regex.split(r"[ \t\n\x0b\x0c\r]+", regex.sub(r'[.,;:!?"()\[\]{}«»¿¡]', "", t or "")):
            if not w:
                continue
            number = lambda x: regex.fullmatch(r"[$€£+\-]?[0-9]+[0-9/:\-]*[%a-z]{0,2}", x)
            slot = (decontamination.NUMBER if number(w) else decontamination.NAME if regex.fullmatch(r"\p{Lu}\p{Ll}[\p{L}'’\-]*", w)
                    else decontamination.UNIT if w in decontamination.UNITS and number(before) else w.lower())
            out.append((w.lower(), slot))
            before = w
        return out

    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    cut = decontamination.tokenised(rows, "text").cache()
    for r in cut.collect():
        assert list(zip(r["_w"], r["_t"])) == plain(texts[r.id])
    got = sorted(map(tuple, decontamination.text_windows(cut, [3, 8], {8}).collect()))
    lists = cut.select("id", decontamination.window_hashes("_p", 3).alias("a"), decontamination.window_hashes("_p", 8).alias("b"),
                       decontamination.window_hashes("_h", 8).alias("c")).collect()
    want = [(r.id, h) for r in lists for h in [*r.a, *r.b, *(c for b, c in zip(r.b, r.c) if b != c)]]
    assert got == sorted(want)
