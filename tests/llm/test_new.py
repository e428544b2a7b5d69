"""Filter audit, fill-in-middle and language identification: SQL, brute force and edge cases."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudflow.llm import fill_middle, filter_audit, html_text, language_id


def audited(rows, labels):
    """Brute force: every order is applied to every part, a document at a time."""
    good, toxic = ({k for k, q, x in labels if k is not None and (q, x)[i] == 1} for i in (0, 1))
    least = {}
    for k, t, _ in rows:
        if k is not None:
            least[t or ""] = min(least.get(t or "", k), k)
    docs = []
    for k, t, p in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        docs.append((p or "", fails | {"E": k is not None and k > least[t]}, k in good and k is not None, k in toxic and k is not None))
    out, total = {}, Counter()
    for part in {p for p, *_ in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            before = []
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in docs if d[0] == part)
                redundant = sum(d[1][f] for d in before)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, alone, sum(d[2] for d in gone), sum(d[3] for d in gone), f]
                before += gone
                total[part, f] += len(gone)
    return {k: (*v[:6], total[k[0], v[6]]) for k, v in out.items()}


def planted():
    rng = random.Random(4)
    rows = []
    for i in range(90):
        words = [rng.choice(["alpha", "Beta", "GAMMA", "d$", "éà", f"w{rng.randint(0, 10**6)}", f"v{rng.randint(0, 10**6)}"]) for _ in range(rng.choice([0, 3, 99, 100, 150]))]
        if rng.random() < 0.5:
            words = [f"u{i}x{j}" for j in range(rng.choice([99, 100, 101]))] + (["A" * 200] if rng.random() < 0.3 else [])
        rows.append((rng.choice([i, i, i, None]), " ".join(words), rng.choice(["en", "de", None, ""])))
    rows += [rng.choice(rows) for _ in range(20)]  # repeated rows
    rows += [(rng.choice([-5, 1000 + i, None]), t, p) for i, (_, t, p) in enumerate(rng.sample(rows, 30))]
    return [*rows, (7, None, "en"), (8, None, "en"), (9, "x" * 300_000, "long"), (10, "\x85  " * 120, "en")]


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_audit_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(filter_audit, "BLOCK", block)
    rows = planted()
    labels = [(i % 95, i % 2, int(i % 3 == 0)) for i in range(120)] + [(None, 1, 1), (3, None, None), (7, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"n": F.lit("clash"), "block": F.lit(1), "rows": F.lit("clash"), "good": F.lit(0)})
    got = filter_audit.filter_audit(docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got.collect()}
    assert found == audited(rows, labels)


def test_audit_of_empty_tables_and_bad_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(docs.limit(0), labels).count() == 0
    out = filter_audit.filter_audit(docs, labels, filters={"A": filter_audit.FILTERS["A"]}).collect()
    assert sorted((r.filter_order, r.step, r.kept, r.removed, r.shapley) for r in out) == [("AE", 1, 0, 1, 2), ("AE", 2, 0, 0, 0), ("EA", 1, 1, 0, 0), ("EA", 2, 0, 1, 2)]
    with pytest.raises(ValueError):
        filter_audit.filter_audit(docs, labels, filters=dict.fromkeys("ABCDFG", filter_audit.FILTERS["A"]))


def test_galloping_merge_counts_every_set_of_lists():
    rng = random.Random(1)
    for n in (0, 1, 30, 3000):
        lists = [sorted(rng.sample(range(3000), rng.choice([0, n // 2, n]))) for _ in range(5)]
        want = Counter(sum(1 << i for i, ids in enumerate(map(set, lists)) if x in ids) for x in range(3000))
        got = filter_audit.merged(lists)
        assert +got == Counter({m: c for m, c in want.items() if m})
    dense = [list(range(0, 2000)), list(range(500, 600)), list(range(5000, 9000))]
    assert filter_audit.merged(dense) == {1: 1900, 3: 100, 4: 4000}
    for bound in range(-1, 12):
        assert filter_audit.gallop([0, 2, 4, 6, 8], 1, bound) == max(1, sum(x < bound for x in [0, 2, 4, 6, 8]))


def cut(key, text):
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "", re.S)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text or ""
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    form = "spm" if h4 % 100 < 20 else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_plain_slices_and_goes_back(spark, monkeypatch):
    rng = random.Random(6)
    made = lambda n: "".join(rng.choice(["ab", "Cé", " ", "\n", "日本", "😀", "<", "P", ">", "S>", "<M"]) for _ in range(n))
    rows = [(i, made(rng.randint(0, 40))) for i in range(150)] + [(1, None), (None, "some words"), (2, ""), (3, "x <S> y"), (3, "x <S> y"), (None, None), (4, "no<"), (5, "1" * 70_000 + "a" * 70_000 + " b" * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("clash"), "output": F.lit(1), "h1": F.lit(1)})
    for chunk in (1 << 16, 8):
        monkeypatch.setattr(fill_middle, "CHUNK", chunk)
        work = fill_middle._cut(("<P>", "<S>", "<M>"), 10, 20)
        import pyarrow as pa

        some = rows if chunk > 8 else rows[:-1]
        h = [hashlib.sha256(f"1:{'' if k is None else k}".encode()).hexdigest() for k, _ in some]
        draws = {f"h{i + 1}": pa.array([int(x[8 * i : 8 * i + 8], 16) for x in h]) for i in range(4)}
        batch = pa.RecordBatch.from_pydict({"id": pa.array([k for k, _ in some]), "text": pa.array([t or "" for _, t in some])} | draws)
        out = [r for b in work([batch]) for r in b.to_pylist()]
        assert [(r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out] == [cut(k, t) for k, t in some]
    monkeypatch.undo()
    found = fill_middle.fill_in_middle(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.doc_id, r.back, r.form, r.n, r.prefix_chars, r.middle_chars, r.output) for r in found) == Counter((k, t or "", c[1], c[0], *c[2:]) for k, t in rows for c in [cut(k, t)])
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_every_container_selects_like_a_list():
    rng = np.random.default_rng(3)
    kinds = set()
    for places in (np.arange(60_000), np.flatnonzero(rng.random(1 << 16) < 0.5), np.flatnonzero(rng.random(1 << 16) < 0.01), np.array([65_535]), np.concatenate([np.arange(9), np.arange(60_000, 65_536)]), np.arange(1 << 16)):
        held = fill_middle.container(places)
        kinds.add(type(held).__name__)
        for i in {0, len(places) - 1, *rng.integers(0, len(places), 200).tolist()}:
            assert held.select(i) == places[i]
    assert kinds == {"ArrayContainer", "BitmapContainer", "RunContainer"}
    text = "ab " * 30_000 + "x" * 70_000 + "é" * 5
    tokens = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    bounds = fill_middle.BoundarySet(text)
    assert len(bounds) == len(tokens) and [bounds.select(i) for i in range(0, len(tokens), 37)] == tokens[::37] and bounds.select(len(tokens)) == len(text)


def kneser_ney(words, order):
    """Interpolated Kneser-Ney straight from its definition, over one language's runs."""
    counts = [Counter() for _ in range(order + 1)]
    for w in words:
        padded = "\0" * (order - 1) + w + "\0"
        for i in range(order - 1, len(padded)):
            counts[order][padded[i - order + 1 : i + 1]] += 1
    for k in range(order - 1, 0, -1):
        counts[k].update(s[1:] for s in counts[k + 1])

    def discount(k):
        n = Counter(counts[k].values())
        return n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5

    discounts = [0, *(discount(k) for k in range(1, order + 1))]

    def p(s, floor):
        if not s:
            return floor
        k = len(s)
        of = {x: c for x, c in counts[k].items() if x[:-1] == s[:-1]}
        lower = p(s[1:], floor)
        if not of:
            return lower
        return max(counts[k][s] - discounts[k], 0) / sum(of.values()) + discounts[k] * len(of) / sum(of.values()) * lower

    return p


def test_models_equal_kneser_ney_by_definition(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 3]), "xx") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = docs.where(~language_id.held_out(F.col("doc_id"))).withColumn("check", F.pmod(F.xxhash64(F.lit("check"), F.col("doc_id").cast("string")), F.lit(8)) == 0).collect()
    used = [w for r in learned if not r.check for w in r.text.split()]
    model = language_id.fit(docs)
    p = kneser_ney(used, language_id.ORDER)
    probe = ["abc", "a", "zz", "cab", "ééé", used[0]]
    codes, _ = language_id.coded(probe)
    strings = ["".join(map(chr, row)) for row in codes.tolist()]
    got = language_id.probability(model.orders[0], codes, model.floor)
    assert np.allclose(got, [p(s, model.floor) for s in strings])
    assert_sums_to_one(model, {c for w in used for c in w} | {"\0"}, ("\0\0\0\0", "\0\0ab", "zzzz"))


def assert_sums_to_one(model, alphabet, contexts):
    """Over all letters and one for all unknown ones."""
    for context in contexts:
        codes = np.array([[ord(c) for c in context + a] for a in [*alphabet, "日"]], np.uint64)
        assert abs(language_id.probability(model.orders[0], codes, model.floor).sum() - 1) < 1e-9


def test_pruned_models_still_sum_to_one(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(20)), "xx") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, whole = language_id.fit(docs, model_strings=300), language_id.fit(docs)
    assert sum(len(o.strings) for o in model.orders[0]) <= 300 < sum(len(o.strings) for o in whole.orders[0])
    for held in (model, whole):
        assert_sums_to_one(held, "abcdef\0", ("\0\0\0a", "bcde", "\0\0\0\0", "aaaa"))


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs.withColumn("s", F.lit("clash")))
    out = language_id.identified(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and len(out) == docs.count()
    assert np.mean([r.rejected for r in held]) < 0.03 and all(0 <= r.score <= 1 for r in out)
    edge = [(1, None), (2, ""), (3, "12 ½ ² !?"), (None, "the and of them"), (5, "日本語の文章です"), (5, "日本語の文章です"), (6, "thing and " * 60_000), (7, "xq" * 300_000)]
    table = spark.createDataFrame(edge, "doc_id long, text string").withColumns({"score": F.lit("clash"), "id": F.lit(1)})
    found = language_id.identified(table, model).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == 8 and [(by[i].lang_pred, by[i].score, by[i].rejected) for i in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert by[None].lang_pred == "en" and not by[None].held_out and by[6].lang_pred == "en" and not by[6].rejected
    assert by[5].rejected and by[7].rejected and by[7].lang_pred in model.languages
    assert language_id.identified(table.limit(0), model).count() == 0
    # held-out rows and rows without a language teach nothing
    taught = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    assert taught.languages == model.languages and all(np.array_equal(a.strings, b.strings) and np.array_equal(a.probability, b.probability) for x, y in zip(taught.orders, model.orders, strict=True) for a, b in zip(x, y, strict=True))
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.fit(nothing) is None and language_id.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in language_id.identified(table, None).collect()} == {"und"}
    digits = spark.createDataFrame([(i, "12 34", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert language_id.fit(digits) is None


def test_languages_know_every_learning_row_and_are_calibrated_by_all_that_were_kept_back(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("abcé" if i % 2 else "defg") for _ in range(4)) for _ in range(6)), "xy"[i % 2]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    checked, plain = [], language_id.calibrate
    monkeypatch.setattr(language_id, "calibrate", lambda model, rows: checked.append(rows.count()) or plain(model, rows))
    model, part = language_id.fit(docs, whole=True), language_id.fit(docs)
    learned = docs.where(~language_id.held_out(F.col("doc_id"))).withColumn("check", F.pmod(F.xxhash64(F.lit("check"), F.col("doc_id").cast("string")), F.lit(8)) == 0).collect()
    assert checked == [sum(r.check for r in learned)] * 2 and checked[0] > 10
    p = kneser_ney([w for r in learned if r.lang == "x" for w in r.text.split()], language_id.ORDER)
    codes, _ = language_id.coded(["defg", "gg", "fedd"])
    got = language_id.probability(model.orders[0], codes, model.floor)
    assert np.allclose(got, [p("".join(map(chr, row)), model.floor) for row in codes.tolist()])
    assert np.allclose(model.usual, part.usual) and model.usual.min() > 1 and model.limit == part.limit < 5 and np.array_equal(model.weights, part.weights)


def test_extraction_from_frames_of_something_else():
    story = [f"Paragraph {i} of the story, which is long enough to be one." + " More of it." * 20 for i in range(6)]
    plain = "".join(f"<p>{x}</p>" for x in story)
    wanted = "\n".join(story)
    menu = '<ul class="menu"><li><a href=x>One</a><li><a href=y>Two</a></ul>'
    for page in (
        f'<body><form id="aspnetForm">{menu}{plain}<footer>foot</footer></form></body>', f"<body><nav><a href=x>One</a> <a href=y>Two</a>{plain}</body>", f'<div class="social">{plain}</div>',
        f'<div id="search">{plain}</div>', f'<section class="legal-content">{plain}</section>', f'<div class="related"><div class="ad">Buy</div>{plain}</div>', f"<div><nav>{menu}</div><div>{plain}</div>",
        f'<form><div class="login"><div class="related">{plain}</div><p>Your name</p></div></form>'.replace("<p>Your name</p>", ""),
    ):
        assert html_text.main_text(page) == wanted
    # long comments, notices and adverts are no frame, nor is anything where enough text is outside
    other = "".join(f"<p>{x}</p>" for x in reversed(story))
    for mark in ('class="comments"', 'id="cookie-notice"', 'class="ads"', "hidden"):
        assert html_text.main_text(f"<p>Short news of today.</p><div {mark}>{other * 3}</div>") == "Short news of today."
    assert html_text.main_text(f'<div class="related">{other}</div>{plain}') == wanted
    assert html_text.main_text(f"<footer>{plain}</footer>") == "" == html_text.main_text("<nav>a</nav>")


def test_extraction_of_headings_headers_and_inline_form_parts():
    plain = "<p>" + "Some words of the story. " * 30 + "</p>"
    text = ("Some words of the story. " * 30).strip()
    assert html_text.main_text(f"<body><header>Site</header><article><header><h1>Title</h1></header>{plain}</article></body>") == f"Title\n{text}"
    assert html_text.main_text(f'<h2 id="related">Related work</h2>{plain}<h2 id="legal">Legal</h2>{plain}') == f"Related work\n{text}\nLegal\n{text}"
    assert html_text.main_text(f'{plain}<h2 class="comments">Nine comments</h2>') == text
    assert html_text.main_text("<p>A line <button type=x>Copy</button>with a <label for=a>mark</label>part and <span hidden>nothing</span>extra<wbr>ordinary ends</p>") == "A line with a part and extraordinary ends"
    # an end without a beginning, a button that never ends, items without ends
    assert html_text.main_text(f"</div></nav>{plain}<p>x <button>y</p>{plain}<ul><li>one<li class=ad>two<li>three</ul>").split("\n") == [text, "x", text, "one", "three"]


def test_packing_takes_little_memory_for_a_slice():
    """4 MB of text in one batch: what a worker takes for it at once stays under 48 MB (some 75 MB where a slice was 1 MB)."""
    import tracemalloc

    import pyarrow as pa

    from fraudflow.llm import packing

    word = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} {i % 7}" for i in range(2000))
    texts = [word] * (4_000_000 // len(word))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    work = packing._tokenise(packing.tokenizer_path(), 4096, 1)
    want = [r for b in work(batch.slice(i, 1) for i in range(batch.num_rows)) for r in b.to_pylist()]
    tracemalloc.start()
    got = [r for b in work([batch]) for r in b.to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == want and most < 48 << 20
