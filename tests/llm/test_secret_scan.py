import hashlib
import random
import re

from pyspark.sql import functions as F

from strata.llm import secret_scan as S

PATTERNS = [("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12),
            ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
            ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16)]


def brute(text):
    spans = []
    for k, (name, pattern, good) in enumerate(PATTERNS):
        spans += [(m.start(), k, m.end(), name) for m in pattern.finditer(text or "") if good(m)]
    return [f"{name}:{s}:{e}" for s, _, e, name in sorted(spans)]


def test_base_spans_match_brute_force(docs, texts):
    rows = {r["doc_id"]: r for r in S.scan_secrets(docs).collect()}
    assert len(rows) == len(texts)
    found = 0
    for i, text in enumerate(texts):
        want = brute(text)
        found += len(want)
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        kinds = [w.split(":")[0] for w in want]
        assert [rows[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [kinds.count(k) for k in ("assign", "access", "hex")]
        assert set(want) <= set(filter(None, rows[i]["spans"].split(",")))
    assert found >= 6


def test_many_matches_keep_their_offsets(spark):
    text = " é ".join(f"{i:020x}" for i in range(700))
    row = S.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["spans"].split(",")[:700] == brute(text)


def test_battery_finds_random_strings_and_leaves_words(spark):
    rng = random.Random(1)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(b64) for _ in range(n)) for n in (32, 40, 44, 64, 88)] * 4
    plain = ["internationalizationConfigurationManagerFactory1", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaA1", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghij01",
             "thisFunctionReturnsTheValueOfTheSetting2", "some/path/that/is/long/and/has/Words/in/it2"]
    rows = [(i, f"x {t} y") for i, t in enumerate(keys + plain)]
    out = {r["doc_id"]: r["n_random"] for r in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(out[i] for i in range(len(keys))) >= 0.8 * len(keys)
    assert sum(out[len(keys) + i] for i in range(len(plain))) == 0


def test_values_after_any_name_reach_the_battery(spark):
    """A value is judged as the bare key is: same span, same decision."""
    rng = random.Random(4)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(b64) for _ in range(n)) + pad for n, pad in ((40, ""), (43, "="), (44, ""), (86, "=="), (88, ""))] * 6
    frames = ["%s", "aws_secret_access_key=%s", "client_key=%s", "see https://h.example/x?sig=%s&v=1", "a_rather_long_name_of_a_setting=%s", "x==%s"]
    rows = [(i * len(keys) + j, f % k) for i, f in enumerate(frames) for j, k in enumerate(keys)]
    plain = ["the_name_of_some_setting=the_value_of_some_setting", "internationalization=configurationManagerFactory"]
    rows += [(-1 - i, t) for i, t in enumerate(plain)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["spans"] for r in S.scan_secrets(table).collect()}
    clean = {r["doc_id"]: r["text"] for r in S.redact(table).collect()}
    found = 0
    for j, key in enumerate(keys):
        bare = out[j] == f"random:0:{len(key)}"
        assert bare or out[j] == ""
        found += bare
        for i, f in enumerate(frames):
            at = f.index("%s")
            assert out[i * len(keys) + j] == (f"random:{at}:{at + len(key)}" if bare else ""), f
            assert clean[i * len(keys) + j] == f % ("[SECRET]" if bare else key)
    assert found >= 0.8 * len(keys)
    assert all(out[-1 - i] == "" for i in range(len(plain)))


def test_redaction_cuts_every_span_and_keeps_the_rest(docs, texts):
    rows = {r["doc_id"]: r for r in S.redact(docs).collect()}
    assert S.redact(docs).columns == docs.columns
    for i, text in enumerate(texts):
        if not brute(text):
            assert rows[i]["text"] == text
        else:
            assert not brute(rows[i]["text"]) and "[SECRET]" in rows[i]["text"]
            assert rows[i]["n_chars"] == len(rows[i]["text"])


def test_odd_and_empty_tables(odd_docs, no_docs):
    assert S.scan_secrets(odd_docs).count() == odd_docs.count()
    assert S.redact(odd_docs).count() == odd_docs.count()
    assert S.scan_secrets(no_docs).count() == 0 and S.redact(no_docs).count() == 0


def test_no_python_in_the_plan(docs):
    plan = S.scan_secrets(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_redact_passes_columns_of_any_name(docs):
    names = ["row", "__base", "__spans", "__assign", "__access", "__hex", "__text", "__judged", "a.b"]
    wide = docs.select("doc_id", "text", "n_chars", *[F.lit(f"mine {n}").alias(n) for n in names])
    out = S.redact(wide)
    assert out.columns == wide.columns and out.count() == wide.count()
    assert out.where(" or ".join(f"`{n}` <> 'mine {n}'" for n in names)).count() == 0
    assert out.where("text like '%[SECRET]%' and n_chars = length(text)").count() > 0
