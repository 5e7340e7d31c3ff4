"""Training-data operators against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import chat, common, components, decontam, fertility, lines, minhash, pieces, quality, registered, repeats, sites, suffixes, toxicity
from strata.llm.common import table

TABLES = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, extra string, score string"
ODD = [(None, None, "a", "b"), (1, "", None, "x"), (2, "one", "y", None), (2, "one", "y", None), (3, None, None, None), (None, "null id " * 30, "", "")]
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, TABLES, "documents").cache()


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([*ODD, (9, LONG, None, None)], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Pages


def test_pages_lose_what_is_no_article():
    page = (
        '<html><head><title>T</title><body><div id=top-menu><a>x</a></div><div class="content"><h2>A &amp; B</h2>text one '
        '<b>bold</b>\n more<ul><li>i1<li>i2</ul><aside>no</aside><div class="user-comments"><p>hi</p></div><p>a<p>b'
        '<form>f<input></form>tail &lt;tag&gt; &nbsp; z</div><script>if(a<b){"</div>"}</script><footer>ff</footer>'
    )
    assert sites.extract(page) == "A & B\ntext one bold more\ni1\ni2\na\nb\ntail <tag> z"
    assert sites.extract(None) == sites.extract("") == sites.extract("<!-- open") == ""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<div class="layout with-sidebar"><article>A</article></div>', "A"),
        ('<div class="site no-header"><article>A</article></div>', "A"),
        ('<div class="sidebar"><article>A</article></div>', "A"),
        ('<article title="The hidden truth">A</article>', "A"),
        ('<p>x <span title="a hidden gem">B</span> <a href="/view?id=comment">C</a></p>', "x B C"),
        ("<article><header><h1>H</h1></header><p class=byline>by</p><div class=toc>t</div><math>m</math><div class=ad>ad</div><nav>n</nav></article>", "H\nby\nt\nm"),
        ("<p title=don't>hello</p><p>x</p>", "hello\nx"),
        ("<p>a<b or c</p><p>d</p>", "a<b or c\nd"),
        ("<p>1 < 2 &amp; 3 > 2</p>", "1 < 2 & 3 > 2"),
        ("<div class=comments><article class=comment>no</article></div><article>yes</article>", "yes"),
        ("<div class=related><article>no</article></div><p>y", "y"),
        ('<div class="user-comments">x</div><div id=top-menu>m</div><p>k', "k"),
        ('<div hidden>x</div><p data-x="hidden">k', "k"),
        ("<article><form>f</form><aside>a</aside><footer>ff</footer>t</article>", "t"),
        ("<main><p>m</p></main><footer>x</footer>", "m"),
    ],
)
def test_markup_is_read_as_it_is_meant(page, text):
    assert sites.extract(page) == text


@pytest.mark.parametrize("bad", ['<a b="', "<a'", "<a b='x\" ", '="', "<p title='", "<a\"<a'", "<!-", '<a b=c"', "<p>"])
def test_long_broken_pages_take_little_time(bad):
    page = bad * (1_000_000 // len(bad))
    start = time.process_time()
    sites.extract(page)
    assert time.process_time() - start < 10


class PlainReader(HTMLParser):
    """Blocks of text inside article elements, by the standard library's parser."""

    OUT = ("script", "style", "aside", "nav", "footer", "form")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out, self.blocks = 0, 0, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.out += tag in self.OUT
        if tag in sites.BLOCK:
            self.blocks.append([])
        if tag == "br":
            self.blocks[-1].append(" ")

    def handle_endtag(self, tag):
        if tag in sites.BLOCK:
            self.blocks.append([])
        self.inside -= tag == "article"
        self.out -= tag in self.OUT

    def handle_data(self, data):
        if self.inside and not self.out:
            self.blocks[-1].append(data)


def test_given_pages_equal_a_plain_reading(spark):
    pages = table(spark, TABLES, "pages").collect()
    found = {r.page_id: r for r in registered.op1_html(spark, TABLES).collect()}
    assert len(found) == len(pages)
    for page in pages:
        reader = PlainReader()
        reader.feed(page.html or "")
        reader.close()
        blocks = [" ".join("".join(b).split()) for b in reader.blocks]
        text = "\n".join(b for b in blocks if b)
        assert (found[page.page_id].text, found[page.page_id].n_chars) == (text, len(text))


def test_unnamed_menus_of_a_small_host_are_removed(spark):
    page = "<body><div class=q1><ul><li>Home<li>Shop</ul></div><div class=q2><h1>Own {0}</h1><p>Words {0}</p></div><div class=q3>Rights</div>"
    rows = [(i, "http://two.example/", page.format(i)) for i in range(2)] + [(9, "http://one.example/", page.format(9))]
    got = {r.page_id: (r.text, r.n_by_tree) for r in sites.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: ("Own 0\nWords 0", 2), 1: ("Own 1\nWords 1", 2), 9: ("Home\nShop\nOwn 9\nWords 9\nRights", 0)}


def test_pages_defined_cases(spark):
    schema = "page_id long, url string, html string, text string, host string, branches string"
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [(None, None, None, "x", "y", "z"), (1, "u", "", "x", "y", "z"), (2, "http://h/", long, "x", "y", "z"), (2, "http://h/", long, "x", "y", "z")]
    got = sites.main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 999_999, 999_999]
    assert sites.main_text(spark.createDataFrame([], schema)).count() == 0
    shuffled = sites.main_text(spark.createDataFrame(rows, schema), sites.Settings(broadcast_bytes=-1)).collect()
    assert sorted(r.n_chars for r in shuffled) == sorted(r.n_chars for r in got)


def test_shared_branches_of_a_site_are_removed(spark):
    rows = [
        (i, f"http://h.example/{i}", f"<body><div class=q1><p>Home</div><div class=q2><p>Own words {i}<p>Shared</div><div class=q3>Rights</div>")
        for i in range(12)
    ]
    rows += [(None, None, None), (99, "http://other.example/", "<div class=q1><p>Home</div>")]
    got = {r.page_id: r.text for r in sites.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Own words {i}\nShared" for i in range(12))
    assert got[None] == "" and got[99] == "Home"


def test_copies_of_a_page_count_once(spark):
    page = lambda n: f"<html><body><div class=box><p>Story {n} of its own.</p></div></body></html>"
    rows = [(i, f"http://five.org/{i}", page("five")) for i in range(5)]
    rows += [(100 + i, f"http://many.org/{i}", page("many")) for i in range(1000)]
    rows += [(2000 + i, f"http://many.org/x{i}", page(i)) for i in range(50)]
    got = {r.page_id: r.text for r in sites.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: sites.extract(html) for i, _, html in rows} and all(got.values())


# SentencePiece


def test_ids_equal_the_library_and_decode_to_the_text(texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    rng = random.Random(1)
    odd = ["", " ", "  a  b\n\tc ", "ﬁ①é\x00x", "日本語", "x" * 700, "in" * 400, "🎉 ok", "".join(rng.choice("ab ./<>1é漢\n") for _ in range(2000))]
    model = pieces.read_model()
    cases = [*odd, *texts.values()]
    ids = pieces.Encoder(model).encode(cases)
    assert ids == library.encode(cases)
    assert pieces.decode(ids, model) == cases
    odd = ["a▁b", None, "\ufdd0", "▁\ufdd0 x▁▁", " ", "  ", ""]
    assert pieces.decode(pieces.Encoder(model).encode(odd), model) == odd
    assert pieces.decode([[3], [model.bytes_at[255]], []], model) == ["\x00" if not model.outputs[3] else model.outputs[3].decode("utf-8", "replace"), "\ufffd", ""]


def test_words_are_forgotten_and_learned_again(texts):
    encoder = pieces.Encoder(pieces.read_model())
    whole = encoder.encode(list(texts.values()))
    encoder.LIMIT = 50
    assert [encoder.encode([t])[0] for t in texts.values()] == whole


def test_columns_of_equal_names_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b", "old", 5, "x"), (2, None, "old", 6, "y")], "doc_id long, text string, ids string, n_tokens int, Decoded string")
    got = pieces.encode_and_decode(docs)
    assert got.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    assert [(r.doc_id, r.decoded, r.n_tokens) for r in got.orderBy("doc_id").collect()] == [(1, "a b", 5), (2, None, 6)]
    assert pieces.encode_and_decode(docs.limit(0)).count() == 0


def test_texts_of_many_words_go_in_small_batches():
    texts = pa.record_batch({"text": [" ".join(f"w{i}" for i in range(20_000)) for _ in range(64)]})
    sizes = [b.num_rows for b in common.pieces(iter([texts]), rows=10_000, size=pieces.BATCH)]
    assert sum(sizes) == 64 and max(sizes) <= 30


def test_encoding_defined_cases(spark, odd):
    got = pieces.round_trip(odd).collect()
    assert len(got) == len(ODD) + 1 and all(r.same for r in got)
    assert pieces.round_trip(empty(spark)).count() == 0


# Classifiers


@pytest.mark.parametrize(
    ("query", "label", "scale", "least"), [(registered.op3_toxicity, "toxic", "0.1", 0.95), (registered.op7_quality, "quality", "0.01", 0.95)]
)
def test_held_out_accuracy(spark, query, label, scale, least):
    tables = f"/root/testdata/sf{scale}"
    found = query(spark, tables).where("held_out").join(table(spark, tables, "labels"), "doc_id").select("predicted", label).collect()
    assert sum(r[0] == r[1] for r in found) >= least * len(found)


def test_the_cut_comes_from_positive_and_unlabelled_scores():
    positive, unlabelled = np.array([0.1, 0.4, 0.5, 0.6]), np.array([0.0, 0.05, 0.1, 0.2, 0.3, 0.35, 0.45, 0.6, 0.0, 0.0])
    assert toxicity.best_cut(positive, unlabelled) == 0.4  # 0.75 ** 2 / 0.2 is the most
    rows = [np.array([i % 7, 100], np.int32) for i in range(60)]
    model = toxicity.train_with_cut([np.array([50, 100 + i % 2], np.int32) for i in range(20)], rows, 0.2, 0.7, toxicity.Settings())
    scores = model.scores([np.array([50, 100], np.int32), rows[0]])
    assert scores[0] >= 0.7 > scores[1]


def test_toxic_texts_are_found(spark):
    tables = "/root/testdata/sf0.1"
    found = registered.op3_toxicity(spark, tables).where("held_out").join(table(spark, tables, "labels"), "doc_id")
    hits, toxic, called = found.selectExpr("sum(toxic * predicted)", "sum(toxic)", "sum(predicted)").first()
    assert hits >= 0.8 * toxic and hits >= 0.9 * called


def test_classifiers_defined_cases(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for found in (toxicity.toxicity(odd, labels), quality.quality(odd, labels), quality.quality(odd, labels.limit(0)), toxicity.toxicity(odd, labels.limit(0))):
        rows = found.collect()
        assert len(rows) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert toxicity.toxicity(empty(spark), labels).count() == quality.quality(empty(spark), labels).count() == 0


def test_risk_stays_non_negative_and_finds_the_word():
    rng = np.random.default_rng(0)
    clean = [np.unique(rng.integers(10, 400, 20)).astype(np.int32) for _ in range(300)]
    bad = [np.unique(np.append(rng.integers(10, 400, 20), 5)).astype(np.int32) for _ in range(60)]
    model = toxicity.train(bad[:30], clean[:200] + bad[30:], 0.13, toxicity.Settings())
    assert model.used[model.weights.argmax()] == 5
    assert np.mean(model.scores(bad[30:])) > np.mean(model.scores(clean[200:])) + 0.3


# Suffix arrays


def test_induced_sorting_orders_suffixes():
    rng = random.Random(3)
    for n in [*range(1, 30), 800]:
        for letters in (1, 2, 5, 250):
            text = np.array([rng.randrange(letters) + 1 for _ in range(n)] + [0])
            order = suffixes.suffix_array(text, 50)
            keys = [tuple(text[i : i + 50]) for i in order]
            assert sorted(order) == list(range(n + 1)) and keys == sorted(keys)


def brute_repeats(rows, length=50):
    seen, out = {}, {}
    for i, text in sorted(rows.items()):
        hit = np.zeros(len(text) + 1, int)
        grams = [text[p : p + length] for p in range(len(text) - length + 1)]
        for p, gram in enumerate(grams):
            if seen.get(gram, i) < i:
                hit[p] += 1
                hit[p + length] -= 1
        for gram in grams:
            seen.setdefault(gram, i)
        gone = np.cumsum(hit)[: len(text)] > 0
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(int)) == 1))
        out[i] = (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_bytes_equal_brute_force(documents, texts):
    expected = brute_repeats({i: (t or "").encode() for i, t in texts.items()})
    got = repeats.remove_repeats(documents, repeats.Settings(shard_bytes=200_000, block_bytes=100_000)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected


@pytest.mark.parametrize("changed", [{}, {"hot": 2, "block_bytes": 700}, {"broadcast_bytes": 0, "shard_bytes": 5_000, "block_bytes": 2_000}, {"hot": 0, "filter_bits": 15}])
def test_repeats_of_any_bytes_equal_brute_force(spark, changed):
    rng = random.Random(str(changed))
    passages = ["".join(rng.choice("\0\1a") for _ in range(rng.randint(40, 160))) for _ in range(6)] + ["\0" * 90, "a\0" * 60, "xyz" * 40]
    texts = {}
    for i in range(240):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("\0\1ab") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 6))]
        texts[i] = "".join(p[rng.randint(0, 30) :] if rng.random() < 0.5 else p for p in parts)
    docs = spark.createDataFrame([(i, t, None, None) for i, t in texts.items()], DOCS).repartition(4)
    got = repeats.remove_repeats(docs, repeats.Settings(**changed)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_repeats({i: t.encode() for i, t in texts.items()})


def test_batches_are_bounded_by_bytes():
    batch = pa.record_batch({"text": ["x" * 1000] * 700 + [None, "y" * 50_000] + ["z"] * 10})
    parts = list(common.pieces(iter([batch]), rows=300, size=100_000))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert max(p.num_rows for p in parts) <= 300 and len(parts) == 8


def test_repeats_defined_cases(spark, odd):
    got = repeats.remove_repeats(odd.union(odd.where("doc_id = 9"))).collect()
    assert len(got) == len(ODD) + 2 and sum(r.n_removed for r in got) == 0
    shared = "z" * 10 + "0123456789" * 5
    rows = [(5, shared, "", ""), (5, shared + "tail", "", ""), (7, "x" + shared, "", "")]
    found = {(r.doc_id, r.n_bytes): r.n_removed for r in repeats.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {(5, 60): 0, (5, 64): 0, (7, 61): 60}
    assert repeats.remove_repeats(empty(spark)).count() == 0


# Near duplicates


def brute_groups(rows, words, percent):
    def shingles(text):
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()

    sets = {i: shingles(t) for i, t in rows.items()}
    parent = {i: i for i in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(rows)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark, texts):
    rng = random.Random(5)
    base = [f"t{rng.randrange(500)}" for _ in range(150)]
    rows = dict(texts)
    for k in range(40):  # a chain: neighbours are similar, its ends are not
        base[(k * 7) % 150] = f"new{k}"
        rows[10_000 + k] = " ".join(base)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for s in (minhash.Settings(words=3, percent=85), minhash.Settings()):
        got = minhash.near_duplicates(df, s).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, s.words, s.percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_defined_cases(spark, odd):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD) + 1 and all(r.kept for r in got)
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    assert minhash.keep_one(odd).columns == odd.columns
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1500).astype(np.uint64)
    a, b = minhash.signature(pool[:1200], 256), minhash.signature(pool[300:], 256)
    assert abs((a == b).mean() - 0.6) < 0.1


def test_components_of_a_long_path(spark):
    links = spark.range(1, 60).selectExpr("id AS a", "id + 1 AS b").union(spark.sql("SELECT 100L, 101L"))
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(2, 61), 1), 101: 100}


# Decontamination


def test_copies_and_edited_copies_of_items_are_found(spark):
    rng = random.Random(2)
    items = {i: [f"{rng.choice('abcdefgh')}{rng.randrange(3000)}" for _ in range(40)] for i in range(6)}
    edited = [w if k % 9 else "changed" for k, w in enumerate(items[2])]
    other = [f"q{rng.randrange(10_000)}" for _ in range(3000)]
    docs = [
        (1, " ".join(other[:500] + items[1] + other[500:900]), "", ""), (2, " ".join(other[:50] + edited + other[60:90]).upper(), "", ""),
        (3, " ".join(other[900:1500]), "", ""), (4, None, "", ""), (None, " ".join(items[3]), "", ""), (5, " ".join(items[0][:8]), "", ""),
    ]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(None, None), (9, "")], "item_id long, text string")
    df = spark.createDataFrame(docs, DOCS)
    for s in (decontam.Settings(), decontam.Settings(block_items=2)):
        hits = {(r.doc_id, r.item_id): (r.score, r.first_word, r.last_word) for r in decontam.contaminated(df, benchmark, s).collect()}
        assert set(hits) == {(1, 1), (2, 2), (None, 3)}
        assert hits[1, 1] == (1.0, 500, 539) and 0.6 <= hits[2, 2][0] < 1
        assert {r.doc_id for r in decontam.decontaminate(df, benchmark, s).collect()} == {3, 4, 5}
    assert decontam.contaminated(empty(spark), benchmark).count() == 0
    assert decontam.decontaminate(df, benchmark.limit(0)).count() == len(docs)


def test_words_of_ascii_texts_are_the_same_ones():
    text = "".join(map(chr, range(128))) + " A_b c-D 1.5e3 x"
    assert decontam.words_of(text) == decontam.TERM.findall(text.lower()) and decontam.words_of(None) == []


def test_punctuation_of_any_kind_separates_words(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, "élan Ünder 東京 straße"), (3, "a_b c")], "item_id long, text string")
    docs = [(1, "“One two—three… four”\u00a0five、six «seven» eight"), (2, "‘ÉLAN’ ünder\u3000東京。straße"), (3, "a b c"), (4, "onetwo threefour fivesix seveneight")]
    hits = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.score) for r in hits} == {(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)}


def test_hits_equal_alignment_of_all_items_with_all_documents(spark):
    rng, s = np.random.default_rng(12), decontam.Settings()
    vocabulary = [f"t{i}" for i in range(400)]
    some = lambda n: list(rng.choice(vocabulary, n))
    items = {i: some(n) for i, n in enumerate([40, 40, 31, 22, 15, 12, 9, 7, 6, 5, 4, 3, 2, 1])}

    def edited(words, kind, share):
        out = []
        for word, hit in zip(words, rng.random(len(words)) < share, strict=True):
            out += [] if hit and kind == "deleted" else ["x"] if hit and kind == "replaced" else [word, "x"] if hit and kind == "inserted" else [word]
        return out

    def regular(words, every, kind):
        return [w for i, word in enumerate(words, 1) for w in ([word] if i % every else {"replaced": ["x"], "inserted": [word, "x"], "deleted": []}[kind])]

    passages = [edited(w, kind, share) for w in items.values() for kind in ("replaced", "inserted", "deleted") for share in (0, 0.1, 0.2, 0.3)]
    passages += [regular(items[0], n, kind) for n, kind in ((5, "replaced"), (4, "replaced"), (3, "inserted"), (2, "inserted"), (5, "deleted"))]
    passages += [items[1], []]
    texts = {i: " ".join(some(60) + p + some(60)) for i, p in enumerate(passages)}
    numbers = defaultdict(lambda: len(numbers) + 1)
    number = lambda words: np.array([numbers[w] for w in words], np.uint64)
    coded = {i: number(w) for i, w in items.items()}
    expected = {}
    for d, text in texts.items():
        words = number(text.split())
        for i, item in coded.items():
            score = decontam.align(item, words, s)[0]
            if score >= s.min_score * s.match * len(item):
                expected[d, i] = score / (s.match * len(item))
    assert {(d, 0) for d in range(len(passages) - 7, len(passages) - 2)} <= expected.keys()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(df, benchmark, s).collect()} == expected


def test_alignment_equals_plain_smith_waterman():
    rng, s = np.random.default_rng(4), decontam.Settings()
    for _ in range(30):
        a, b = rng.integers(0, 6, 15).astype(np.uint64), rng.integers(0, 6, 25).astype(np.uint64)
        h = np.zeros((16, 26), int)
        for i in range(1, 16):
            for j in range(1, 26):
                h[i, j] = max(0, h[i - 1, j - 1] + (s.match if a[i - 1] == b[j - 1] else s.mismatch), h[i - 1, j] + s.gap, h[i, j - 1] + s.gap)
        assert decontam.align(a, b, s)[0] == h.max()


# Chat


def test_conversations_read_back(spark):
    groups = defaultdict(list)
    for r in table(spark, TABLES, "conversations").collect():
        groups[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    said = "</s>[INST] ok [/INST]"
    groups[-7] = [(0, "user", said), (1, "assistant", said)]
    got = {r.conv_id: r for r in registered.op8_chat(spark, TABLES).collect()}
    assert got.keys() == groups.keys()
    for conv_id, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, role, t in turns)
        r = got[conv_id]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert (r.turns_sha256, r.loss_sha256) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss))


def test_layouts_and_escapes(spark):
    records = {
        '{"messages":[{"content":"a","role":"user"},{"role":"assistant","content":null}]}': [("user", "a"), ("assistant", "")],
        '{"output":"y","instruction":"x"}': [("user", "x"), ("assistant", "y")],
        '{"input":"z","output":"y","instruction":"x"}': [("user", "x\nz"), ("assistant", "y")],
        '{"conversations":[{"from":"u","value":"v"}]}': [("u", "v")],
        '{"prompt":"p","completion":7}': [("user", "p"), ("assistant", "7")],
        '{"messages":[]}': [],
        '{"id":3,"messages":[{"role":"user","content":"a","name":{"x":1}}],"meta":{"role":2}}': [("user", "a")],
        '{"prompt":"p","completion":"c","source":"web"}': [("user", "p"), ("assistant", "c")],
        '{"prompt":"p","completion":"c","messages":[]}': None,
        '{"messages":[{"zz":1}]}': None,
        "[1]": None,
        '{"zz":1}': None,
        "not json": None,
    }
    df = spark.createDataFrame([(r,) for r in records], "record string")
    got = {r.record: r.turns and [tuple(t) for t in r.turns] for r in chat.canonical_turns(df, "record", "turns").collect()}
    assert got == {k: v or None if v is None else v for k, v in records.items()}
    rows = [(1, 0, "us\ner", "a\\<|end|>\\\\<\\|end|>"), (1, 1, "assistant", "[INST]<s>\\</s><<SYS>>"), (1, None, None, "é<|text|>"), (None, 0, "assistant", None)]
    back = {r.conv_id: r for r in chat.chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [tuple(t) for t in back[1].turns] == [("", "é<|text|>"), ("us\ner", rows[0][3]), ("assistant", rows[1][3])]
    assert back[1].loss_text == rows[1][3] and back[None].loss_text == ""


def test_unknown_records_leave_a_trace(spark):
    rows = [(1, 0, '{"role":"user","text":"a"}'), (1, 1, '{"zz":1}'), (2, 0, "broken"), (3, 0, '{"messages":[]}')]
    df = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    turns = chat.canonical_turns(df, "record", "turns")
    got = {r.conv_id: (len(r.turns), r.n_unknown) for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 0)}


def test_chat_defined_cases(spark):
    schema = "conv_id long, turn long, role string, text string, record string, turns string, items string"
    long = "x " * 200_000
    rows = [(1, 0, "user", long, "", "", ""), (1, 1, None, None, "", "", ""), (1, 1, None, None, "", "", ""), (None, None, "", "", "", "", "")]
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.chat(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: [("user", long), ("", ""), ("", "")], None: [("", "")]}
    assert chat.digests(chat.chat(spark.createDataFrame([], schema))).count() == 0


# Lines


def brute_lines(rows, least):
    order = [(i, p, line) for i, t in sorted(rows.items()) for p, line in enumerate((t or "").split("\n")) if words_of(line)]
    by_doc, gone, seen = defaultdict(list), defaultdict(set), {}
    for i, p, line in order:
        by_doc[i].append((p, line))
    runs = []
    for i, own in by_doc.items():
        for a in range(len(own)):
            total = 0
            for b in range(a, len(own)):
                total += len(words_of(own[b][1]))
                if total >= least:
                    runs.append((i, own[a][0], own[b][0], tuple(x for _, x in own[a : b + 1])))
                    break
        for b in range(len(own)):
            total = 0
            for a in range(b, -1, -1):
                total += len(words_of(own[a][1]))
                if total >= least:
                    runs.append((i, own[a][0], own[b][0], tuple(x for _, x in own[a : b + 1])))
                    break
    for i, lo, hi, content in sorted(runs, key=lambda r: (r[0], r[1])):
        if seen.setdefault(content, (i, lo)) != (i, lo):
            gone[i] |= set(range(lo, hi + 1))
    return {i: t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]) for i, t in rows.items()}


def test_repeated_runs_equal_brute_force(spark, texts):
    rng = random.Random(8)
    pool = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 30))) for _ in range(12)]
    rows = dict(texts) | {1000 + k: "\n".join(rng.choice([*pool, ""]) for _ in range(25)) for k in range(30)}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}
    assert got == brute_lines(rows, 50)


def test_lines_defined_cases(spark, odd):
    got = lines.dedup_lines(odd, removed="n")
    assert got.columns == [*odd.columns, "n"] and got.count() == len(ODD) + 1
    assert got.agg(F.sum("n")).first()[0] == 0
    assert lines.dedup_lines(empty(spark)).count() == 0


# Quality rules


def test_counts_equal_brute_force(documents, texts, odd):
    def brute(text):
        words = words_of(text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        twice = {w for w, n in Counter(windows).items() if n > 1}
        hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            dup += bool(words_of(line)) and line in seen
            seen.add(line)
        return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), dup, len(hit)

    got = {r.doc_id: r for r in fertility.quality_rules(documents).collect()}
    for i, text in texts.items():
        r = got[i]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts == brute(text)
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0]) and not (r.kept and r.base_failed)
    assert fertility.quality_rules(odd).count() == len(ODD) + 1


def test_bands_keep_labelled_good_texts(spark, documents):
    good = table(spark, TABLES, "labels").where("quality = 1").select("doc_id")
    judged = fertility.quality_rules(documents).join(good, "doc_id").where("not base_failed")
    assert judged.where("kept").count() == judged.count() > 0


@pytest.mark.parametrize("prior", [0, 500, 10**9])  # bands as measured, drawn part of the way, and the fixed limits alone
def test_bands_reject_junk_and_keep_labelled_good_texts(spark, documents, prior):
    rng = np.random.default_rng(3)

    def junk(letters):
        return " ".join("".join(rng.choice(list(letters), rng.integers(2, 10))) for _ in range(200))

    made = [junk("abcdefghijklmnopqrstuvwxyz"), junk("bcdfghjklmnpqrstvwxz"), junk("qxzjkvw")]
    rows = documents.select("doc_id", "text").union(spark.createDataFrame([(-1 - i, text) for i, text in enumerate(made)], "doc_id long, text string"))
    judged = fertility.quality_rules(rows, fertility.Rules(prior_documents=prior)).where("not base_failed")
    assert {r.doc_id: r.kept for r in judged.where("doc_id < 0").collect()} == {-1: False, -2: False, -3: False}
    good = judged.join(table(spark, TABLES, "labels").where("quality = 1").select("doc_id"), "doc_id")
    assert good.where("kept").count() == good.count() > 0


def test_pages_of_letters_no_piece_covers():
    assert fertility.script_of("привет мир".encode()) == "cyrillic" and fertility.script_of(b"12 34") == "other"
    assert fertility.repeated(np.array([1, 2, 3] * 8), 8) == 24
