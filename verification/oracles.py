"""SQL texts (DuckDB) that give the same rows as the registered queries, from the same tables.

Trained models have texts under settings that SQL can follow: one split, given weights, moments at the
optimum. A query without a text is a full training run or a random sample; those are covered by
properties in the tests.
"""

from __future__ import annotations

import numpy as np

from clickloom.operators.fm_math import CLASSIFICATION, REGRESSION, Shape
from verification.fixtures import (
    CROSSED,
    FM_FACTORS,
    FM_INIT_STD,
    FM_REG,
    FM_STEP_SIZE,
    FM_STEPS,
    LABEL,
    NET,
    SEED,
)

# The sample table, as a chain of CTEs ending in ``samples``.
SAMPLES = """
e AS (
  SELECT event_id, ts, CAST(user_id AS INT) AS user_id,
         CAST(json_extract_string(props, '$.k') AS INT) AS item_id,
         CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS label
  FROM events),
history AS (
  SELECT *,
    COALESCE(SUM(label) OVER ui, 0) AS ui_click, COUNT(*) OVER ui AS ui_imp,
    COALESCE(SUM(label) OVER i, 0) AS i_click, COUNT(*) OVER i AS i_imp,
    COUNT(*) OVER u AS u_imp
  FROM e
  WINDOW ui AS (PARTITION BY user_id, item_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         i AS (PARTITION BY item_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         u AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
joined AS (
  SELECT h.event_id, h.user_id, h.item_id, CAST(h.item_id % 10 AS INT) AS category_id,
    concat('c', CAST(ie.label AS VARCHAR)) AS content_type,
    CAST(CAST(floor(epoch(h.ts)) AS BIGINT) AS VARCHAR) AS "timestamp",
    CAST(h.ui_click AS BIGINT) AS user_item_click, ln(1.0E0 + h.ui_imp) AS user_item_imp,
    (h.i_click + 1.0E0) / (h.i_imp + 20.0E0) AS item_ctr,
    CASE WHEN h.u_imp < 5 THEN 1 ELSE 0 END AS is_new_user,
    CAST(ue.embedding AS DOUBLE[]) AS user_embedding, CAST(ie.embedding AS DOUBLE[]) AS item_embedding,
    h.label
  FROM history h JOIN embeddings ue ON ue.vec_id = h.user_id JOIN embeddings ie ON ie.vec_id = 499 - h.item_id),
samples AS MATERIALIZED (
  SELECT *, CASE WHEN CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0E0
      < 1.0E0 / (1.0E0 + exp(-(-0.5E0 + 5.0E0 * list_dot_product(user_embedding, item_embedding)
        + 1.0E0 * (CASE WHEN content_type < 'c5' THEN 1 ELSE 0 END) - 1.5E0 * is_new_user)))
    THEN 1 ELSE 0 END AS label_planted,
    CAST('0x' || substr(md5(CAST(event_id + 7 AS VARCHAR)), 1, 8) AS BIGINT) % 1000 AS split_bucket
  FROM joined)"""


def on_samples(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SAMPLES.strip(), *[c.strip() for c in ctes]]) + "\n" + select.strip()


COSINE = """CASE WHEN list_dot_product(user_embedding, user_embedding) * list_dot_product(item_embedding, item_embedding) = 0
  THEN 0.0 ELSE list_dot_product(user_embedding, item_embedding)
    / (sqrt(list_dot_product(user_embedding, user_embedding)) * sqrt(list_dot_product(item_embedding, item_embedding))) END"""
HADAMARD = "list_transform(range(len(user_embedding)), lambda j: user_embedding[j + 1] * item_embedding[j + 1])"

CUTS = """
ordered AS (
  SELECT item_ctr, row_number() OVER (ORDER BY item_ctr) AS rn, count(*) OVER () AS n FROM fitted),
ranks AS (SELECT CAST(range AS BIGINT) AS i FROM range(1, 100)),
cuts AS (SELECT i, item_ctr AS cut FROM ordered JOIN ranks ON rn = (i * n + 99) // 100),
cut_list AS (SELECT list(DISTINCT cut) AS cuts FROM cuts)"""
CATEGORIES = """
categories AS (
  SELECT content_type, CAST(row_number() OVER (ORDER BY count(*) DESC, content_type) - 1 AS INT) AS idx
  FROM fitted GROUP BY content_type)"""
TAIL = {
    "base": "list_concat(user_embedding, item_embedding)",
    "inner": f"[{COSINE}]",
    "outer": HADAMARD,
}


def features(layout: str, fitted: str = "TRUE", scaler: str = "minmax") -> list[str]:
    """CTEs ending in ``x``: event_id, split_bucket, label_planted, item_ctr, position, value."""
    if scaler == "minmax":
        scaled = "CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0.5E0 END"
    else:
        scaled = "CASE WHEN std > 0 THEN (value - mean) / std ELSE 0.0E0 END"
    return [
        f"fitted AS (SELECT * FROM samples WHERE {fitted})",
        CUTS,
        CATEGORIES,
        f"""
raw AS (
  SELECT event_id, split_bucket, label_planted, item_ctr,
    list_concat(
      list_concat(
        list_transform(range((SELECT count(*) FROM categories)), lambda j: CASE WHEN j = idx THEN 1.0E0 ELSE 0.0E0 END),
        [CAST(len(list_filter((SELECT cuts FROM cut_list), lambda c: c <= item_ctr)) AS DOUBLE),
         CAST(user_item_click AS DOUBLE), user_item_imp, CAST(is_new_user AS DOUBLE)]),
      {TAIL[layout]}) AS v
  FROM samples JOIN categories USING (content_type))""",
        """
long AS MATERIALIZED (
  SELECT event_id, split_bucket, label_planted, item_ctr,
         unnest(range(len(v))) AS position, unnest(v) AS value FROM raw)""",
        f"""
bounds AS (
  SELECT position, min(value) AS lo, max(value) AS hi, avg(value) AS mean, stddev_samp(value) AS std
  FROM long WHERE {fitted} GROUP BY position)""",
        f"""
x AS MATERIALIZED (
  SELECT event_id, split_bucket, label_planted, item_ctr, position, {scaled} AS value
  FROM long JOIN bounds USING (position))""",
    ]


FEATURES = "SELECT event_id, CAST(position AS INT) AS position, round(value, 6) AS value FROM x"

SAMPLE_COLUMNS = on_samples("""
SELECT event_id, user_id, item_id, category_id, content_type, "timestamp", user_item_click,
  round(user_item_imp, 6) AS user_item_imp, round(item_ctr, 6) AS item_ctr, is_new_user,
  round(list_sum(user_embedding), 6) AS user_embedding_sum,
  round(list_sum(item_embedding), 6) AS item_embedding_sum, label, label_planted
FROM samples""")

# Naive Bayes, fitted on the training part: class priors and one log share per class and position.
TRAINING = "split_bucket < 700"
BAYES = [
    *features("base", TRAINING),
    f"prior AS (SELECT label_planted AS class, count(*) AS n FROM samples WHERE {TRAINING} GROUP BY 1)",
    """
pi AS (
  SELECT class, ln(n + 1.0E0) - ln((SELECT sum(n) FROM prior) + (SELECT count(*) FROM prior) * 1.0E0) AS pi FROM prior)""",
    f"""
sums AS (
  SELECT label_planted AS class, position, sum(value) AS total FROM x WHERE {TRAINING} GROUP BY 1, 2)""",
    """
theta AS (
  SELECT class, position,
    ln(total + 1.0E0) - ln(sum(total) OVER (PARTITION BY class) + count(*) OVER (PARTITION BY class) * 1.0E0) AS theta
  FROM sums)""",
]
BAYES_SCORE = on_samples(
    "SELECT event_id, round(1.0E0 / (1.0E0 + exp(raw0 - raw1)), 6) AS ctr FROM wide",
    *BAYES,
    f"""
evidence AS (
  SELECT event_id, class, sum(theta * value) AS score
  FROM x JOIN theta USING (position) WHERE NOT ({TRAINING}) GROUP BY 1, 2)""",
    """
wide AS (
  SELECT event_id, sum(CASE WHEN class = 0 THEN score + pi END) AS raw0,
         sum(CASE WHEN class = 1 THEN score + pi END) AS raw1
  FROM evidence JOIN pi USING (class) GROUP BY 1)""",
)

# Factorization machines: weights as a table with two factors per position.
FIXED_WEIGHTS = """
weights AS (
  SELECT position, (position % 5 - 2) / 10.0E0 AS lin,
    ((2 * position) % 7 - 3) / 20.0E0 AS v0, ((2 * position + 1) % 7 - 3) / 20.0E0 AS v1
  FROM (SELECT DISTINCT position FROM x)),
bias AS (SELECT 0.1E0 AS b)"""


def fm_forward(weights: str, bias: str, name: str) -> str:
    """CTE with the raw score and the two factor sums of every row."""
    return f"""
{name} AS MATERIALIZED (
  SELECT event_id, any_value(label_planted) AS label_planted, any_value(item_ctr) AS item_ctr,
    sum(value * v0) AS s0, sum(value * v1) AS s1,
    (SELECT b FROM {bias}) + sum(value * lin)
      + 0.5E0 * (pow(sum(value * v0), 2) + pow(sum(value * v1), 2) - sum(value * value * (v0 * v0 + v1 * v1))) AS raw
  FROM x JOIN {weights} USING (position) GROUP BY event_id)"""


def fm_pull(forward: str, name: str, task: int) -> str:
    """CTE with each row's loss and its derivative by the raw score."""
    if task == CLASSIFICATION:
        sign = "(CASE WHEN label_planted > 0 THEN 1.0E0 ELSE -1.0E0 END)"
        return f"""
{name} AS MATERIALIZED (
  SELECT event_id, s0, s1, ln(1.0E0 + exp(-{sign} * raw)) AS loss, -{sign} / (1.0E0 + exp({sign} * raw)) AS pull
  FROM {forward})"""
    clamped = (
        "greatest(least(raw, (SELECT max(item_ctr) FROM samples)), (SELECT min(item_ctr) FROM samples))"
    )
    return f"""
{name} AS MATERIALIZED (
  SELECT event_id, s0, s1, 0.5E0 * pow({clamped} - item_ctr, 2) AS loss, {clamped} - item_ctr AS pull
  FROM {forward})"""


def fm_gradient(pull: str, weights: str, name: str) -> str:
    """CTE with the mean gradient by position."""
    return f"""
{name} AS MATERIALIZED (
  SELECT position, avg(pull * value) AS lin,
    avg(pull * s0 * value) - any_value(v0) * avg(pull * value * value) AS v0,
    avg(pull * s1 * value) - any_value(v1) * avg(pull * value * value) AS v1
  FROM x JOIN {pull} USING (event_id) JOIN {weights} USING (position) GROUP BY position)"""


def weight_rows(weights: str, bias: str) -> str:
    return f"""
SELECT 'bias' AS part, 0 AS position, 0 AS factor, round({bias}, 6) AS value
UNION ALL SELECT 'linear', CAST(position AS INT), 0, round(lin, 6) FROM {weights}
UNION ALL SELECT 'factor', CAST(position AS INT), 0, round(v0, 6) FROM {weights}
UNION ALL SELECT 'factor', CAST(position AS INT), 1, round(v1, 6) FROM {weights}"""


FM_GRADIENT = on_samples(
    """
SELECT 'loss' AS part, 0 AS position, 0 AS factor, round((SELECT avg(loss) FROM pulls), 6) AS value
UNION ALL SELECT 'rows', 0, 0, CAST((SELECT count(*) FROM pulls) AS DOUBLE)
UNION ALL """ + weight_rows("gradient", "(SELECT avg(pull) FROM pulls)").strip(),
    *features("inner"),
    FIXED_WEIGHTS,
    fm_forward("weights", "bias", "forward"),
    fm_pull("forward", "pulls", CLASSIFICATION),
    fm_gradient("pulls", "weights", "gradient"),
)

# One-hot crossings of user and item in front of two numbers, as active entries.
WIDE_X = f"""
x AS MATERIALIZED (
  SELECT event_id, label_planted, item_ctr, position, value FROM (
    SELECT event_id, label_planted, item_ctr,
      unnest([(CAST(user_id AS BIGINT) * 1009 + CAST(item_id AS BIGINT) * 9176) % {CROSSED}, {CROSSED}, {CROSSED + 1}]) AS position,
      unnest([1.0E0, user_item_imp, item_ctr]) AS value FROM samples)
  WHERE value <> 0)"""
WIDE_STEP = [WIDE_X, FIXED_WEIGHTS, fm_forward("weights", "bias", "forward")]
WIDE_GRADIENT = on_samples(
    """
SELECT 'loss' AS part, 0 AS position, 0 AS factor, round((SELECT avg(loss) FROM pulls), 6) AS value
UNION ALL SELECT 'rows', 0, 0, CAST((SELECT count(*) FROM pulls) AS DOUBLE)
UNION ALL """ + weight_rows("gradient", "(SELECT avg(pull) FROM pulls)").strip(),
    *WIDE_STEP,
    fm_pull("forward", "pulls", CLASSIFICATION),
    """
gradient AS MATERIALIZED (
  SELECT position, sum(pull * value) / (SELECT count(*) FROM pulls) AS lin,
    (sum(pull * s0 * value) - any_value(v0) * sum(pull * value * value)) / (SELECT count(*) FROM pulls) AS v0,
    (sum(pull * s1 * value) - any_value(v1) * sum(pull * value * value)) / (SELECT count(*) FROM pulls) AS v1
  FROM x JOIN pulls USING (event_id) JOIN weights USING (position) GROUP BY position)""",
)

# Widths of the inner layout: ten content types, bucket, clicks, impressions, new user, cosine.
INNER_WIDTH = 15

# The best split of three 0/1 features: the largest gain in variance, which ranks like Gini for two classes.
STUMP = [
    """
flags AS (
  SELECT event_id, label_planted AS y, CAST(is_new_user AS INT) AS f0,
    CASE WHEN content_type < 'c5' THEN 1 ELSE 0 END AS f1, CASE WHEN user_item_click > 0 THEN 1 ELSE 0 END AS f2 FROM samples)""",
    """
sides AS (
  SELECT feature, side, count(*) AS n, avg(y) AS p FROM (
    SELECT event_id, y, unnest([0, 1, 2]) AS feature, unnest([f0, f1, f2]) AS side FROM flags) GROUP BY 1, 2)""",
    """
best AS (SELECT feature FROM sides GROUP BY 1 HAVING count(*) = 2 ORDER BY sum(n * p * (1 - p)), feature LIMIT 1)""",
    """
sided AS (
  SELECT event_id, [f0, f1, f2][(SELECT feature FROM best) + 1] AS side FROM flags)""",
    "leaf AS (SELECT event_id, s.side, s.p FROM sided JOIN sides s ON s.side = sided.side AND s.feature = (SELECT feature FROM best))",
]


def network_forward(layout: str, width: int) -> str:
    """One hidden layer of sigmoids, then a softmax of two, with weights by rule of their place."""
    hidden = width // 2
    weight = "((7 * ({k})) % 11 - 5) / 20.0E0"
    first, second = (width + 1) * hidden, (width + 1) * hidden + 2 * hidden
    units = f"units AS (SELECT CAST(range AS INT) AS o FROM range({hidden}))"
    layer = f"""
layer AS (
  SELECT event_id, o, 1.0E0 / (1.0E0 + exp(-(sum(value * {weight.format(k=f"position * {hidden} + o")}) + any_value({weight.format(k=f"{width * hidden} + o")})))) AS h
  FROM x CROSS JOIN units GROUP BY 1, 2)"""
    outs = f"""
outs AS (
  SELECT event_id, sum(h * {weight.format(k=f"{first} + 2 * o")}) + {weight.format(k=second)} AS z0,
    sum(h * {weight.format(k=f"{first} + 2 * o + 1")}) + {weight.format(k=second + 1)} AS z1 FROM layer GROUP BY 1)"""
    return on_samples("SELECT event_id, round(1.0E0 / (1.0E0 + exp(z0 - z1)), 6) AS ctr FROM outs", *features(layout), units, layer, outs)


def fm_training(task: int) -> str:
    """Gradient descent from the trainer's own initial factors, one group of CTEs per step."""
    shape = Shape(INNER_WIDTH, FM_FACTORS)
    factors, _, _ = shape.unpack(shape.initial(FM_INIT_STD, SEED))
    start = ", ".join(f"({i}, 0.0E0, {np.format_float_scientific(a)}, {np.format_float_scientific(b)})"
                      for i, (a, b) in enumerate(factors))
    ctes = [
        f"weights0 AS (SELECT * FROM (VALUES {start}) AS w(position, lin, v0, v1))",
        "bias0 AS (SELECT 0.0E0 AS b)",
    ]
    reg_bias, reg_linear, reg_factors = FM_REG
    for t in range(1, FM_STEPS + 1):
        old, step = t - 1, f"({FM_STEP_SIZE}E0 / sqrt({t}.0E0))"
        ctes += [
            fm_forward(f"weights{old}", f"bias{old}", f"forward{t}"),
            fm_pull(f"forward{t}", f"pulls{t}", task),
            fm_gradient(f"pulls{t}", f"weights{old}", f"gradient{t}"),
            f"""
weights{t} AS MATERIALIZED (
  SELECT position, w.lin - {step} * (g.lin + {reg_linear} * w.lin) AS lin,
    w.v0 - {step} * (g.v0 + {reg_factors} * w.v0) AS v0, w.v1 - {step} * (g.v1 + {reg_factors} * w.v1) AS v1
  FROM weights{old} w JOIN gradient{t} g USING (position))""",
            f"""
bias{t} AS MATERIALIZED (
  SELECT b - {step} * ((SELECT avg(pull) FROM pulls{t}) + {reg_bias} * b) AS b FROM bias{old})""",
        ]
    return on_samples(
        weight_rows(f"weights{FM_STEPS}", f"(SELECT b FROM bias{FM_STEPS})"), *features("inner"), *ctes
    )


AREAS = [
    f"scored AS (SELECT round({COSINE}, 2) AS score, {LABEL} AS label FROM samples)",
    "g AS (SELECT score, CAST(sum(label) AS DOUBLE) AS tp, CAST(count(*) - sum(label) AS DOUBLE) AS fp FROM scored GROUP BY 1)",
    """
running AS (
  SELECT score, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(fp) OVER (ORDER BY score DESC) AS cfp,
         sum(tp) OVER () AS npos, sum(fp) OVER () AS nneg FROM g)""",
    """
points AS (
  SELECT score, ctp / npos AS rec, ctp / (ctp + cfp) AS prec, cfp / nneg AS fpr,
    lag(ctp / npos) OVER (ORDER BY score DESC) AS lrec, lag(ctp / (ctp + cfp)) OVER (ORDER BY score DESC) AS lprec,
    lag(cfp / nneg) OVER (ORDER BY score DESC) AS lfpr
  FROM running)""",
]


def portable_net() -> str:
    """The network spelled out over scaled inputs."""
    inputs = [
        "CASE WHEN kind = 'movie' THEN 1.0E0 ELSE 0.0E0 END", "CASE WHEN kind = 'series' THEN 1.0E0 ELSE 0.0E0 END",
        "CAST(ctr_bucket AS DOUBLE)", "CAST(user_item_click AS DOUBLE)", "user_item_imp",
        "CAST(is_new_user AS DOUBLE)", "cosine",
    ]
    e = np.format_float_scientific
    scaled = ", ".join(
        f"({x} - ({e(float(m))})) / ({e(float(r))}) AS x{i}"
        for i, (x, m, r) in enumerate(zip(inputs, NET.minimums, NET.ranges))
    )

    def neuron(n, prefix: str) -> str:
        return " + ".join([f"({e(n.bias)})", *[f"({e(w)}) * {prefix}{i}" for i, w in enumerate(n.weights)]])

    hidden = ", ".join(f"1.0E0 / (1.0E0 + exp(-({neuron(n, 'x')}))) AS h{i}" for i, n in enumerate(NET.hidden))
    no, yes = (neuron(n, "h") for n in NET.output)
    cuts = ", ".join(e(c) for c in NET.ctr_cuts)
    return on_samples(
        f"""
SELECT event_id, CAST(ctr_bucket AS DOUBLE) AS ctr_bucket, round(1.0E0 / (1.0E0 + exp(({no}) - ({yes}))), 6) AS ctr
FROM hidden""",
        f"""
inputs AS (
  SELECT event_id, user_item_click, user_item_imp, is_new_user, {COSINE} AS cosine,
    CASE WHEN content_type < 'c4' THEN 'movie' WHEN content_type < 'c8' THEN 'series' ELSE 'other' END AS kind,
    len(list_filter([{cuts}], lambda c: c <= item_ctr / 20.0E0)) AS ctr_bucket
  FROM samples)""",
        f"scaled AS (SELECT event_id, ctr_bucket, {scaled} FROM inputs)",
        f"hidden AS (SELECT event_id, ctr_bucket, {hidden} FROM scaled)",
    )


ALL = "fitted AS (SELECT * FROM samples)"

ORACLES: dict[str, str] = {
    "sample_table": SAMPLE_COLUMNS,
    "sample_orc": SAMPLE_COLUMNS,
    "embedding_to_vector": on_samples("""
SELECT event_id, CAST(j AS INT) AS position, round(user_embedding[j + 1], 6) AS user_value,
       round(item_embedding[j + 1], 6) AS item_value
FROM (SELECT event_id, user_embedding, item_embedding, unnest(range(len(user_embedding))) AS j FROM samples)"""),
    "embedding_cosine": on_samples(
        f"SELECT event_id, round({COSINE}, 6) AS embedding_inner_product FROM samples"
    ),
    "embedding_hadamard": on_samples("""
SELECT event_id, CAST(j AS INT) AS position, round(user_embedding[j + 1] * item_embedding[j + 1], 6) AS value
FROM (SELECT event_id, user_embedding, item_embedding, unnest(range(len(user_embedding))) AS j FROM samples)"""),
    "hash_split": on_samples("""
SELECT event_id, CASE WHEN split_bucket < 700 THEN 'train' ELSE 'validation' END AS part, split_bucket AS bucket
FROM samples"""),
    "label_checks": on_samples("""
SELECT event_id, CAST(label AS DOUBLE) AS as_double, CASE WHEN label > 0 THEN 1.0E0 ELSE -1.0E0 END AS as_sign,
  label IN (0, 1) AS valid, user_item_click IN (0, 1) AS clicks_valid, CAST(label AS DOUBLE) AS required
FROM samples"""),
    "category_index": on_samples("""
SELECT event_id, content_type, CAST(idx AS DOUBLE) AS content_type_index
FROM samples JOIN categories USING (content_type)""", ALL, CATEGORIES),
    "category_onehot": on_samples("""
SELECT event_id, CAST(c.idx AS INT) AS position, CASE WHEN c.content_type = s.content_type THEN 1.0E0 ELSE 0.0E0 END AS value
FROM samples s CROSS JOIN categories c""", ALL, CATEGORIES),
    "ctr_quantile_cuts": on_samples("SELECT CAST(i AS INT) AS i, round(cut, 9) AS cut FROM cuts", ALL, CUTS),
    "ctr_quantile_bucket": on_samples("""
SELECT event_id, CAST(len(list_filter((SELECT cuts FROM cut_list), lambda c: c <= item_ctr)) AS DOUBLE) AS ctr_bucket
FROM samples""", ALL, CUTS),
    "features_base": on_samples(FEATURES, *features("base")),
    "features_inner": on_samples(FEATURES, *features("inner")),
    "features_outer": on_samples(FEATURES, *features("outer")),
    "standard_scaled": on_samples(FEATURES, *features("inner", scaler="standard")),
    "nb_parameters": on_samples("""
SELECT CAST(class AS INT) AS class, CAST(position AS INT) AS position, round(pi, 6) AS pi, round(theta, 6) AS theta
FROM theta JOIN pi USING (class)""", *BAYES),
    "nb_score": BAYES_SCORE,
    "batch_score": BAYES_SCORE,
    "stream_score": BAYES_SCORE,
    "fm_score_fixed": on_samples(
        """
SELECT event_id, round(1.0E0 / (1.0E0 + exp(-raw)), 6) AS ctr, CASE WHEN raw > 0 THEN 1.0E0 ELSE 0.0E0 END AS prediction
FROM forward""",
        *features("inner"), FIXED_WEIGHTS, fm_forward("weights", "bias", "forward"),
    ),
    "fm_gradient_step": FM_GRADIENT,
    "fm_gd_steps": fm_training(CLASSIFICATION),
    "fm_regression_steps": fm_training(REGRESSION),
    "fm_label_range_clamp": on_samples(
        """
SELECT event_id, round(greatest(least(raw, high), low), 6) AS prediction, round(low, 6) AS low, round(high, 6) AS high
FROM forward CROSS JOIN (SELECT min(item_ctr) AS low, max(item_ctr) AS high FROM samples)""",
        *features("inner"), FIXED_WEIGHTS, fm_forward("weights", "bias", "forward"),
    ),
    "auc_roc": on_samples(
        "SELECT round(sum((fpr - coalesce(lfpr, 0)) * (rec + coalesce(lrec, 0)) / 2), 6) AS auc_roc FROM points", *AREAS
    ),
    "auc_pr": on_samples(
        "SELECT round(sum((rec - coalesce(lrec, 0)) * (prec + coalesce(lprec, prec)) / 2), 6) AS auc_pr FROM points",
        *AREAS,
    ),
    "portable_net_score": portable_net(),
    "random_split": on_samples("SELECT event_id, CAST(1 AS BIGINT) AS parts FROM samples"),
    "mini_batch_whole": on_samples("SELECT event_id FROM samples"),
    "lr_moments": on_samples(
        "SELECT CAST(position AS INT) AS position, round(avg(label_planted * value), 3) AS moment, round(sum(label_planted * value), 6) AS observed, TRUE AS met FROM x GROUP BY 1", *features("inner")
    ),
    "nn_forward": network_forward("base", 142),
    "ipnn_forward": network_forward("inner", 15),
    "opnn_forward": network_forward("outer", 78),
    "rf_stump_score": on_samples("SELECT event_id, round(p, 6) AS ctr FROM leaf", *STUMP),
    "gbt_stump_score": on_samples("SELECT event_id, round(1.0E0 / (1.0E0 + exp(-2 * (2 * p - 1))), 6) AS ctr FROM leaf", *STUMP),
    "gbtlr_stump_leaves": on_samples("SELECT event_id, CAST(side AS INT) AS leaf FROM leaf", *STUMP),
    "gbtlr_stump_rules": on_samples("""
SELECT CAST(0 AS INT) AS "treeID", CAST(leaf AS INT) AS leaf, concat('feature ', feature, CASE leaf WHEN 0 THEN ' <= 0.5' ELSE ' > 0.5' END) AS rule
FROM best CROSS JOIN (VALUES (0), (1)) sides_of(leaf)""", *STUMP),
    "gbtlr_leaf_counts": on_samples("SELECT event_id, CAST(10 AS INT) AS leaves FROM samples WHERE split_bucket >= 700"),
}
for name in ("nn", "ipnn", "opnn"):
    ORACLES[f"tables_{name}_score"] = ORACLES[f"{name}_forward"]
ORACLES["tables_nb_score"] = BAYES_SCORE
ORACLES["tables_rf_stump"], ORACLES["tables_gbt_stump"] = ORACLES["rf_stump_score"], ORACLES["gbt_stump_score"]
ORACLES["tables_trained"] = on_samples(f"""
SELECT event_id, model, TRUE AS same FROM samples CROSS JOIN (VALUES ('lr'), ('rf'), ('gbdt'), ('gbtlr'), ('fm'), ('ipnn')) m(model)
WHERE NOT ({TRAINING})""")
ORACLES["fm_sparse_steps"] = ORACLES["fm_table_steps"] = ORACLES["fm_gd_steps"]
ORACLES["fm_wide_score"] = on_samples("SELECT event_id, round(1.0E0 / (1.0E0 + exp(-raw)), 6) AS ctr FROM forward", *WIDE_STEP)
ORACLES["fm_wide_gradient"] = ORACLES["fm_wide_gradient_table"] = WIDE_GRADIENT
ORACLES["fm_saved_score"] = ORACLES["fm_score_fixed"]
