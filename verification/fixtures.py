"""Fixed numbers that the queries and their SQL texts share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.embeddings import dot
from clickloom.plans.portable_net import Neuron, PortableNet
from clickloom.sources.impressions import sample_table

DIM = 64
LABEL = "label_planted"
SEED = 17

# Fixed values of the test sample: which vector an item has, and the planted label's logit.
LAST_ITEM_VECTOR = 499
PLANTED_BIAS, PLANTED_DOT, PLANTED_TYPE, PLANTED_NEW = -0.5, 5.0, 1.0, -1.5


def planted_samples(events: DataFrame, embeddings: DataFrame, *cuts: int, references: str | None = None) -> DataFrame:
    """The sample table of the test tables, with a second label that can be learned."""
    samples = sample_table(events, embeddings, *cuts, item_of=lambda vec_id: LAST_ITEM_VECTOR - vec_id, references=references)
    return samples.withColumn(LABEL, _planted_label())


def _planted_label() -> Column:
    """A coin weighted by the row's features, drawn from a hash of the row key."""
    logit = (
        PLANTED_BIAS
        + PLANTED_DOT * dot(F.col("user_embedding"), F.col("item_embedding"))
        + PLANTED_TYPE * F.when(F.col("content_type") < "c5", 1).otherwise(0)
        + PLANTED_NEW * F.col("is_new_user")
    )
    prefix = F.substring(F.md5(F.col("event_id").cast("string")), 1, 8)
    draw = F.conv(prefix, 16, 10).cast("bigint") / F.lit(4294967296.0)
    return F.when(draw < 1.0 / (1.0 + F.exp(-logit)), 1).otherwise(0)


# Weights for scoring checks: simple functions of the position, also written out in SQL.
FM_BIAS = 0.1
FM_FACTORS = 2


def fm_linear(i: int) -> float:
    return (i % 5 - 2) / 10


def fm_factor(i: int, f: int) -> float:
    return ((2 * i + f) % 7 - 3) / 20


def net_weight(k: int) -> float:
    """The k-th of a network's weights in forward checks."""
    return ((7 * k) % 11 - 5) / 20


# The wide check: a one-hot crossing of user and item, then two numbers, in one sparse vector.
CROSSED = 120_000
WIDE = CROSSED + 2


def wide_entries() -> Column:
    """The active entries of an impression as a struct of indices and values."""
    crossing = (F.col("user_id").cast("long") * 1009 + F.col("item_id").cast("long") * 9176) % CROSSED
    indices = F.array(crossing.cast("int"), F.lit(CROSSED), F.lit(CROSSED + 1))
    return F.struct(indices.alias("indices"), F.array(F.lit(1.0), F.col("user_item_imp"), F.col("item_ctr")).alias("values"))


# Settings of the training checks.
FM_STEPS = 5
FM_STEP_SIZE = 0.5
FM_INIT_STD = 0.1
FM_REG = (0.01, 0.001, 0.0001)

# The exported network with seven inputs, three hidden neurons and two outputs.
NET = PortableNet(
    content_types=("movie", "series"),
    ctr_cuts=(
        4.083924651590178e-4, 9.190233897369148e-4, 0.0016314451568843192, 0.0020618079043691795,
        0.002318840579710145, 0.002611818478615736, 0.0030195030195030196, 0.003248741778286688,
        0.0035089986093212876, 0.003705390086511438, 0.003945032546518509, 0.00421664167916042,
        0.0044207090936062895, 0.004677114958562403, 0.004910767756617559, 0.005073012135990359,
        0.005245778297943488, 0.0054361391143958274, 0.005609551398326881, 0.0057458744077119985,
        0.0059683910866791005, 0.006081754842809286, 0.006223672725892755, 0.006344692443722219,
        0.006525943668105491, 0.006688434800926901, 0.006859280814799418, 0.007007896049541932,
        0.007165304839723444, 0.007357904684757661, 0.007524626652571781, 0.007669172932330827,
        0.007883763356789157, 0.008063698143827975, 0.008310893010921716, 0.008480435083191224,
        0.008686636590355032, 0.008889724057183331, 0.00907704417986815, 0.009272183449651047,
        0.009473724913963111, 0.009652989012353343, 0.00986134353334927, 0.010065534595749303,
        0.010213453623828679, 0.010457010069713401, 0.010618093922651934, 0.010802469135802469,
        0.010990869124112276, 0.011116790186557628, 0.011272733637907192, 0.011382098550942405,
        0.01149076244731376, 0.01162469210274971, 0.01177717503563967, 0.011879049676025918,
        0.012015650637384828, 0.012196958289414245, 0.012406486687421588, 0.012574222843171499,
        0.012728078771757897, 0.012836378636771735, 0.01306680512287989, 0.013259615230074415,
        0.013496932515337423, 0.013694743412714925, 0.013883721968423088, 0.014126382831011636,
        0.014316862374234901, 0.01463323702115761, 0.014985763524651582, 0.0151894911671448,
        0.0155596579135742, 0.01591483528252581, 0.016469696447644972, 0.01692466460268318,
        0.017481451367008842, 0.01811028539311809, 0.01879155825383059, 0.01949769869169717,
        0.020256404598512766, 0.02054821534214159, 0.021258407545184686, 0.021764076380561895,
        0.0221, 0.022235442849706254, 0.02337452982267598, 0.02425564681724846,
        0.026379877851557296, 0.029274589315505545, 0.03215132975402672, 0.03406963389499851,
        0.03543536542720597,
    ),
    minimums=(0, 0, 0, 0, 0, 0, -0.32890289521601157),
    ranges=(1, 1, 93, 17, 8.869257522797287, 1, 1.3289028952160122),
    hidden=(
        Neuron(0.10821106718224807, (
            7.4158800534998415, -6.070759979235586, 0.6100101719515445, 3.9824460081767588,
            0.6887823107311685, -2.312955573745862, 0.5744933930473881)),
        Neuron(7.724919390429448, (
            -7.877489337161427, 16.102657157262858, -0.574322416659433, -9.052147320695367,
            1.446872262529019, -1.1666234973430543, -1.4301013745226279)),
        Neuron(6.178231499154114, (
            -7.828092740188026, 14.913477905278286, -5.537300486986441, -9.53419994442785,
            -0.31034203112906017, 7.025683153503286, 0.9261008781780328)),
    ),
    output=(
        Neuron(5.3014576554877495, (-4.411423237039245, 5.917952261903428, -0.0020390453880317454)),
        Neuron(-4.484682941980783, (3.6380923296236425, -3.918333126547335, -2.2003957185251064)),
    ),
)
