"""The training-data operators against brute force on small fixtures, edge rows included."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from quipu.llm import byte_dedup, html_text, inner_topk, lang_id, near_vectors, ngram_join, packing, piece_bpe, pitman_yor, queries, span_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(60)) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base, passage = words(rng, 150), words(rng, 70)
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join([*base[:80], "x", *base[81:]])),
            (4, " ".join([*words(rng, 60), *passage, *words(rng, 40)])), (5, "\t".join([*words(rng, 30), *passage, *words(rng, 90)])),
            (6, None), (7, ""), (8, "one two"), (9, "One  two"), (10, "One two"), (None, " ".join(base)), (None, None),
            (11, "é" * 900), (12, " ".join(words(rng, 4000))), (12, " ".join(base)), (13, "  \n "), (14, "ab " * 400), (1, " ".join(base)),
            (15, " ".join([*base[:40], *words(rng, 9), *base[49:]]))]
    rows += [(100 + i, " ".join([*base[:i], "y%d" % i, *base[i + 1:]])) for i in range(0, 150, 6)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if (i or 0) % 2 else "de", None, len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).withColumnsRenamed({"source": "rk"}).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(rows):
    return sorted(rows, key=str)


def split(text):
    return (text or "").encode().split()


def sets(texts):
    out = []
    for i, t in texts:
        w = split((t or "").encode().lower().decode())
        k = min(5, len(w))
        out.append((i, frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if w else frozenset()))
    return out


@pytest.mark.parametrize("grams", [ngram_join.GRAMS, 400])
def test_ngram_join(docs, texts, grams):
    rows = sets(texts)
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                label = [label[b] if v == label[a] else v for v in label]
    low = collections.defaultdict(list)
    for (i, _), v in zip(rows, label, strict=True):
        if i is not None:
            low[v].append(i)
    want = [(i, len(s), min(low[v], default=None)) for (i, s), v in zip(rows, label, strict=True)]
    got = [tuple(r) for r in ngram_join.similarity_classes(docs, grams=grams).collect()]
    assert key(got) == key(want)


def test_keep_one(docs, texts):
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len([k for k in kept if k[1] == texts[0][1]]) == 1 and (1, texts[0][1]) in kept
    assert sum(1 for k in kept if not split(k[1])) == sum(1 for t in texts if not split(t[1]))


def test_span_dedup(docs, texts):
    first = {}
    for i, t in texts:
        w = split(t)
        for s in range(len(w) - 49):
            if i is not None:
                first[tuple(w[s:s + 50])] = min(i, first.get(tuple(w[s:s + 50]), i))
    want = []
    for i, t in texts:
        w = split(t)
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if i is not None and first[tuple(w[s:s + 50])] < i:
                gone[s:s + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    got = span_dedup.remove_repeats(docs, keep=("lang", "rk"))
    assert key(tuple(r)[:4] for r in got.drop("kept").collect()) == key(want)
    assert any(x[2] for x in want)


@pytest.mark.parametrize("hot", [byte_dedup.HOT, 0])
def test_byte_dedup(docs, texts, hot):
    n = 400
    count = collections.Counter(b[s:s + n] for _, t in texts for b in [(t or "").encode()] for s in range(len(b) - n + 1))
    want = []
    for i, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - n + 1):
            if count[b[s:s + n]] > 1:
                gone[s:s + n] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = byte_dedup.remove_repeats(docs, hot=hot).drop("spans")
    assert key(tuple(r) for r in got.collect()) == key(want)


def test_byte_dedup_long_text(spark, monkeypatch):
    monkeypatch.setattr(byte_dedup, "CHUNK", 512)
    rng = random.Random(3)
    a, b = (bytes(rng.choices(b"abcdefgh ", k=3000)).decode() for _ in range(2))
    places = [list(byte_dedup.pieces((x).encode())) for x in (a + b[500:1600], b)]
    assert sum(len(p[3]) for p in places[1]) == 3000 - 399


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(100 + i, (x[i] * 3).tolist()) for i in range(20)] + [(150 + i, (x[0] + rng.normal(size=8) * .05).tolist()) for i in range(40)]
    rows += [(200, None), (201, [0.0] * 8), (202, [1.0, None] + [0.0] * 6), (203, [float("nan")] + [1.0] * 7),
             (204, [float("inf")] * 8), (None, x[0].tolist()), (205, x[0].tolist()), (206, []), (207, x[1].tolist()[:4]), (205, x[0].tolist())]
    return rows, spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, block int").repartition(4)


def good(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def wide(v):
    return np.array(list(v) + [0.0] * (8 - len(v)))


@pytest.mark.parametrize("block", [near_vectors.BLOCK, 16])
def test_near_vectors(vectors, block, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", block)
    rows, df = vectors
    ok = [(k, i, wide(v) / np.linalg.norm(wide(v))) for k, (i, v) in enumerate(rows) if i is not None and good(v) and any(v)]
    label, links = list(range(len(rows))), [0] * len(rows)
    for k, _, x in ok:
        for m, _, y in ok:
            if k != m and x @ y >= .95:
                links[k] += 1
                label = [label[m] if v == label[k] else v for v in label]
    low = {v: min(i for (i, _), w in zip(rows, label, strict=True) if w == v and i is not None) for v, (i, _) in zip(label, rows, strict=True) if i is not None}
    want = [(i, links[k], None if i is None else low[label[k]], None if i is None else i == low[label[k]]) for k, (i, _) in enumerate(rows)]
    got = [tuple(r) for r in near_vectors.near_duplicates(df).collect()]
    assert key((i, n, c) for i, n, c, _ in got) == key((i, n, c) for i, n, c, _ in want)
    assert all(k == (i == c) for i, _, c, k in got if i is not None)


@pytest.mark.parametrize("group", [inner_topk.GROUP, 8])
def test_inner_topk(vectors, group, monkeypatch):
    monkeypatch.setattr(inner_topk, "GROUP", group)
    monkeypatch.setattr(inner_topk, "QUERIES", 3)
    rows, df = vectors
    ok = [(i, np.floor(256 * wide(v)).astype(int)) for i, v in rows if i is not None and good(v)]
    want = []
    for i, q in ok:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in ok if j != i)[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    got = inner_topk.top_k(df, queries.F.col("vec_id") % 50 == 0)
    assert key(tuple(r) for r in got.collect()) == key(want)


def test_products_beyond_doubles():
    big = np.full((2, 3), 2.0 ** 30)
    assert inner_topk.products(big, big[0]).tolist() == [3 * 2 ** 60] * 2


def test_language_id(spark, docs, texts):
    train = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_id.learn(train, lang_id.vocabulary_of(queries.tokenizer_path("piece_bpe_32k.model"), 6), per_lang=30, rounds=2)
    got = lang_id.predict(train, model, keep=("lang",)).filter("held_out").collect()
    assert len(got) > 100 and sum(r["lang_pred"] == r["kept"]["lang"] for r in got) >= .98 * len(got)
    edge = lang_id.predict(docs, model).collect()
    assert len(edge) == len(texts)
    by = {r["doc_id"]: r for r in edge}
    assert by[6]["lang_pred"] == by[7]["lang_pred"] == by[13]["lang_pred"] == "und" and by[6]["score"] == 0
    assert by[None]["held_out"] is None and by[8]["held_out"] == (zlib.crc32(b"8") % 5 == 0)
    assert all(0 <= r["score"] <= 1 for r in edge)


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab"]
    p = np.array([[.1], [.2], [.3], [.15], [.05], [.2]])
    want = .1 * .2 * .3 + .1 * .15 + .05 * .3 + .2
    got = lang_id.forward(["ab"], lang_id.Lattice(pieces), p)
    assert math.isclose(float(np.exp(got[0, 0])), want, rel_tol=1e-9)


def test_pitman_yor(docs, texts):
    held = queries.F.crc32(queries.F.col("doc_id").cast("string")) % 7 == 2
    got = pitman_yor.score_documents(docs, held).collect()
    count = collections.Counter()
    rows = []
    for i, t in texts:
        w = [*split((t or "").encode().lower().decode()), None]
        h = None if i is None else zlib.crc32(str(i).encode()) % 7 == 2
        rows.append((i, h, w))
        if h is False:
            count.update(w)
    n, v = sum(count.values()), len(count)
    want = [(i, h, len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)) for i, h, w in rows]
    assert key((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == key(want)
    assert all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got if r["held_out"] is False) > sum(r["base_score"] for r in got if r["held_out"] is False)


def test_pitman_yor_is_a_distribution():
    rng = np.random.default_rng(0)
    count = np.array([50, 7, 3, 1, 1])
    tables = pitman_yor.seat(count, .8, 1.0, np.zeros(5), np.full(5, .1), rng)
    assert ((1 <= tables) & (tables <= count)).all()
    t = pitman_yor.Totals([*([0] * 16), int(count.sum()), *([0] * 16), int(tables.sum()), 5, 5])
    root = t.root(tables, np.ones(5))
    rest = (pitman_yor.ROOT_STRENGTH + pitman_yor.ROOT_DISCOUNT * 5) * t.base / (pitman_yor.ROOT_STRENGTH + tables.sum())
    assert math.isclose(root.sum() + rest, 1.0)
    p = (count - .8 * tables) / (1 + count.sum()) + t.back_off()[16] * root
    assert math.isclose(p.sum() + t.back_off()[16] * rest, 1.0)


@pytest.mark.parametrize("hot", [pitman_yor.HOT, 1])
def test_pitman_yor_context_is_the_word_before(spark, hot):
    # the words before end in the same byte; each is followed by its own word alone
    follows = {f"c{i}a": f"w{i}" for i in range(8)}
    rng = random.Random(1)
    rows = [(i, " ".join(x for u in rng.choices(list(follows), k=20) for x in (u, follows[u]))) for i in range(60)]
    rows += [(100, "c1a w1"), (101, "c1a w2"), (102, "w1 c1a"), (103, "never seen")]
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(6), queries.F.col("doc_id") >= 100, hot=hot).collect()}
    assert got[100] > got[101] + 1.5
    assert sum(got[i] for i in range(60)) / 60 > -20 * math.log10(8) * 1.25


@pytest.mark.parametrize("hot", [pitman_yor.HOT, 1])
def test_pitman_yor_of_words_seen_once(spark, hot):
    # each word once: all seats are fixed, so the predictive probabilities are too
    rows = [(1, "a b c"), (2, "a b"), (3, "b z a")]
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(
        spark.createDataFrame(rows, "doc_id long, text string"), queries.F.col("doc_id") > 1, hot=hot).collect()}
    rest = (10 + .6 * 4) / 5
    known, new = (.4 + rest) / 14, rest / 14
    seen, other = .2 / 2 + 1.8 / 2 * known, 1.8 / 2
    want = {1: [seen] * 4, 2: [seen, seen, other * known], 3: [other * known, other * new, known, other * known]}
    for i, p in want.items():
        assert math.isclose(got[i], sum(map(math.log10, p)), rel_tol=1e-9)


def test_packing(docs, texts):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = []
    for i, t in texts:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]  # noqa: B905
    got = packing.pack_documents(docs, path).collect()
    assert key(tuple(r)[:5] for r in got) == key(want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_best_fit_equals_one_by_one():
    rng = random.Random(1)
    for _ in range(50):
        cap = rng.choice([10, 17, 64])
        counts = collections.Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 120)))
        bins: list[int] = []
        for x in sorted(counts.elements(), reverse=True):
            fit = min((b for b in bins if b >= x), default=None)
            if fit is None:
                bins.append(cap - x)
            else:
                bins[bins.index(fit)] -= x
        used = collections.defaultdict(int)
        for length, rank, each, first, _ in (runs := packing.best_fit(counts, cap)):
            upto = min([r[1] for r in runs if r[0] == length and r[1] > rank], default=counts[length])
            for r in range(upto - rank):
                used[first + r // each] += length
        assert sorted(used.values()) == sorted(cap - b for b in bins)


def test_sentencepiece(docs, texts):
    import sentencepiece
    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = []
    for i, t in texts:
        ids = sp.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert key(tuple(r) for r in piece_bpe.encode_digests(docs, path).collect()) == key(want)
    plain = {(r["doc_id"], tuple(r["ids"])): r["decoded"] for r in piece_bpe.encode_documents(docs, path).collect()}
    assert all(plain[(i, tuple(sp.encode(t or "")))] == sp.decode(sp.encode(t or "")) for i, t in texts)


def test_sentencepiece_odd_texts():
    import sentencepiece
    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), piece_bpe.piece_model(path)
    rng = random.Random(4)
    odd = ["  a ", "▁x▁▁y", "a" * 900, "日本語 ½\x00", "<s> <0x0A>"] + [
        "".join(rng.choice("abth e▁ \n.é😀日er") for _ in range(rng.randint(1, 400))) for _ in range(200)]
    for t in odd:
        ids = [x for w in model.encode_words([piece_bpe.MARK + w for w in piece_bpe.split_words(t)]) for x in w]
        assert ids == sp.encode(t) and model.decode(ids) == sp.decode(ids)


def test_html(spark):
    page = ("<title>no</title><h1>Head</h1><p>one <b>two</b>\n three<p>next<ul><li>a<li>b<ol start=3><li>x</ol></ul>"
            "<table><tr><th>Name<th>N<tr><td>alpha<td>1</table><div hidden>no</div><p style='display:none'>no</p><pre> a  b\n  c</pre>&amp;")
    want = "Head\n\none two three\n\nnext\n\n- a\n- b\n\n  3. x\n\nName   N\nalpha  1\n\n a  b\n  c\n\n&"
    rows = [(1, page, 0), (2, None, 0), (3, "", 0), (4, "<div>" * 3000 + "deep", 0), (None, "x<br>y", 0), (1, page, 0), (5, "plain", 0)]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id long, html string, text int")).collect()
    assert key(tuple(r) for r in got) == key([(1, want), (2, None), (3, ""), (4, "deep"), (None, "x\ny"), (1, want), (5, "plain")])


@pytest.mark.parametrize("depth", [3, 200, 20_000])
def test_html_rules_hold_at_any_depth(depth):
    inner = ("<p>a<script>no</script><style>no</style><template>no</template><div hidden>no<span>no</span>no</div>"
             "<ul><li>x<li>y</ul><table><tr><td>c<td>d</table><pre> e  f</pre>")
    for tag in ("div", "font", "span"):
        want = "a\n\n- x\n- y\n\nc  d\n\n e  f\n\nend"
        assert html_text.page_text(f"<{tag}>" * depth + inner + f"</{tag}>" * depth + "end").split("\n") == want.split("\n")
    assert html_text.page_text("<div hidden>" + "<font>" * depth + "<div>no</div>no</div>yes") == "yes"


def test_html_formulas_and_drawings():
    page = ("<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math> holds"
            "<svg><title>no</title><defs><text>no</text></defs><metadata>no</metadata><text>low</text><text>high</text></svg> end"
            "<dialog>no</dialog><dialog open>yes</dialog>")
    assert html_text.page_text(page).split() == "so x=2 holds low high end yes".split()


def test_empty_tables(spark, empty):
    path = queries.tokenizer_path("piece_bpe_32k.model")
    assert ngram_join.similarity_classes(empty).count() == 0
    assert span_dedup.remove_repeats(empty).count() == 0
    assert byte_dedup.remove_repeats(empty).count() == 0
    assert packing.pack_documents(empty, queries.tokenizer_path("byte_bpe_50k.json")).count() == 0
    assert piece_bpe.encode_digests(empty, path).count() == 0
    assert pitman_yor.score_documents(empty, queries.F.lit(False)).count() == 0
    assert lang_id.predict(empty, lang_id.learn(empty, lang_id.vocabulary_of(path, 3))).count() == 0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors.near_duplicates(none).count() == 0
    assert inner_topk.top_k(none, queries.F.col("vec_id") % 50 == 0).count() == 0
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_pipeline(docs, spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got, at = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, "").write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        got[name] = at
    for name in ("language_id", "ngram_join", "span_dedup"):
        assert got[name].columns == docs.columns
    source = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got["language_id"].count() == sum(any(map(str.isalpha, t or "")) for t in source.values())
    kept = {r["doc_id"]: r["text"] for r in got["ngram_join"].collect()}
    assert all(source[i] == t for i, t in kept.items()) and len(set(kept.values())) == len(kept)
    cut = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got["span_dedup"].collect()}
    assert cut.keys() == kept.keys() and all(len(t) == n for t, n in cut.values() if t != source)
    assert {r["doc_id"] for r in got["packing"].collect()} == kept.keys()


def test_pitman_yor_chunks_follow_the_tokens(spark):
    """The number of shuffle partitions changes neither the chunks nor the scores."""
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 17}" for j in range(1, 30))) for i in range(60)], "doc_id long, text string").repartition(2).cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in ("2", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append(sorted((r["doc_id"], round(r["score"], 9)) for r in pitman_yor.score_documents(rows, F.col("doc_id") % 7 == 2).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]


def test_pitman_yor_sweeps_write_their_seats_alone(spark, monkeypatch):
    """What no sweep changes is written once, not again in every sweep."""
    from pyspark.sql import functions as F
    pinned, pin_table = {}, pitman_yor.pin_table
    monkeypatch.setattr(pitman_yor, "pin_table", lambda rows, name: pinned.setdefault(name, pin_table(rows, name)))
    rows = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 7}" for j in range(1, 12))) for i in range(20)], "doc_id long, text string")
    assert pitman_yor.score_documents(rows, F.col("doc_id") % 7 == 2).count() == 20
    kinds = {name: {r["kind"] for r in table.select("kind").distinct().collect()} for name, table in pinned.items() if name != "index"}
    assert len(kinds) >= 10 and not any(pitman_yor.STATE in k for k in kinds.values())


def test_pitman_yor_packs_places_and_samples_as_steps():
    rng = np.random.default_rng(4)
    hashes = np.sort(rng.integers(0, 1 << 64, 10_000, "u8"))
    arrays = {"w": np.concatenate([hashes, hashes[::-1]]), "ids": np.arange(0, 90_000, 9, "u4")[::-1], "u": np.zeros(0, "u4"), "count": rng.integers(0, 9, 100).astype("u4")}
    got = pitman_yor.unpack(pitman_yor.pack(**arrays))
    assert list(got) == list(arrays) and all(got[k].dtype == x.dtype and (got[k] == x).all() for k, x in arrays.items())
    assert len(pitman_yor.pack(w=hashes)) < 7.2 * len(hashes)
    samples = {s: rng.integers(0, 1 << 33, 50) for s in (2, 3, 4)}
    found = pitman_yor.from_changes(pitman_yor.small_changes(samples, "held"), "held", samples)
    assert all((found[s] == samples[s]).all() for s in samples)
