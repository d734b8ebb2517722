import hashlib

from pyspark.sql import functions as F

from strata.llm import mixing as M


def fill(budget, children):
    """children: name -> (supply, weight); water filling by bisection-free rounds."""
    left = {k for k, (s, w) in children.items() if w > 0}
    got = {k: 0.0 for k in children}
    while left:
        level = (budget - sum(v for k, v in got.items() if k not in left)) / sum(children[k][1] for k in left)
        full = {k for k in left if children[k][0] < level * children[k][1]}
        if not full:
            for k in left:
                got[k] = level * children[k][1]
            break
        for k in full:
            got[k] = children[k][0]
        left -= full
    return {k: int(min(v, children[k][0]) + 1e-6) for k, v in got.items()}


def test_shortages_go_to_siblings_before_ancestors(spark):
    config = M.MixConfig(budget_tokens=1000, max_epochs=1, domain_weights={"a": 1, "b": 1}, lang_weights={}, source_weights={})
    leaves = spark.createDataFrame([("a", "en", "s1", 100, 1), ("a", "en", "s2", 900, 1), ("b", "en", "s3", 800, 1), ("b", "de", "s4", 10, 1)],
                                   "domain string, lang string, source string, tokens long, docs long")
    got = {r["source"]: r["budget"] for r in M.leaf_budgets(leaves, config).collect()}
    assert got == {"s1": 100, "s2": 400, "s3": 490, "s4": 10}        # a: 500, b: 500; each shortage stays in its branch
    config = M.MixConfig(budget_tokens=1500, max_epochs=1, domain_weights={"a": 1, "b": 1}, lang_weights={}, source_weights={})
    got = {r["source"]: r["budget"] for r in M.leaf_budgets(leaves, config).collect()}
    assert got == {"s1": 100, "s2": 650, "s3": 740, "s4": 10}
    config = M.MixConfig(budget_tokens=1800, max_epochs=1, domain_weights={"a": 1, "b": 3}, lang_weights={}, source_weights={"s1": 0})
    got = {r["source"]: r["budget"] for r in M.leaf_budgets(leaves, config).collect()}
    assert got["s3"] == 800 and got["s4"] == 10 and got["s1"] == 0 and got["s2"] == 900


def test_choice_matches_brute_force(docs):
    for config in (M.MixConfig(bucket_rows=3), M.MixConfig(budget_share=1.0, bucket_rows=2), M.MixConfig(budget_share=0.3, max_epochs=3)):
        rows = docs.select("doc_id", "text", M.domain_of(F.col("source")).alias("d"), "lang", "source").collect()
        tokens = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in rows}
        leaves: dict = {}
        for r in rows:
            leaves.setdefault((r["d"], r["lang"], r["source"]), []).append(r["doc_id"])
        supply = {k: sum(tokens[i] for i in v) * config.max_epochs for k, v in leaves.items()}
        weights = (config.domain_weights, config.lang_weights, config.source_weights)

        def share(prefix, budget):
            depth = len(prefix)
            if depth == 3:
                return {prefix: budget}
            names = {k[:depth + 1] for k in leaves if k[:depth] == prefix}
            parts = fill(budget, {n: (sum(s for k, s in supply.items() if k[:depth + 1] == n), weights[depth].get(n[-1], config.default_weight)) for n in names})
            out = {}
            for n, b in parts.items():
                out |= share(n, b)
            return out

        budgets = share((), int(sum(tokens.values()) * config.budget_share))
        want = {}
        for leaf, ids in leaves.items():
            total = max(1, sum(tokens[i] for i in ids))
            epochs, left = divmod(budgets[leaf], total)

            def draw(i):
                return int(hashlib.md5(f"{config.seed}:{epochs}:{i}".encode()).hexdigest()[:13], 16)

            run = 0
            for i in sorted(ids, key=lambda i: (draw(i), i)):
                run += tokens[i]
                copies = epochs + (run <= left)
                if copies:
                    want[i] = copies
        got = {r["doc_id"]: r["copies"] for r in M.choose(docs, config).collect()}
        assert got == want


def test_mix_returns_rows_per_copy(docs, odd_docs, no_docs):
    config = M.MixConfig(budget_share=1.0)
    chosen = {r["doc_id"]: r["copies"] for r in M.choose(docs, config).collect()}
    out = M.mix(docs, config)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == chosen
    assert M.mix(odd_docs, config).count() > 0 and M.choose(odd_docs).count() > 0
    assert M.mix(no_docs).count() == 0 and M.choose(no_docs).count() == 0


def test_columns_of_any_name_pass_through(docs):
    from pyspark.sql import functions as F
    names = ["row", "__domain", "__lang", "__tok", "__copies", "__draw", "__bucket", "__id", "a.b", "text2"]
    wide = docs.select("doc_id", "text", "lang", "source", *[F.lit(f"mine {n}").alias(n) for n in names])
    out = M.mix(wide, M.MixConfig(budget_share=1.0)) if "M" in globals() else mixing.mix(wide, mixing.MixConfig(budget_share=1.0))
    assert out.columns == wide.columns and out.count() > 0
    assert out.where(" or ".join(f"`{n}` <> 'mine {n}'" for n in names)).count() == 0
