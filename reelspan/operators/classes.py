"""Object classes: model index, class id and name, and the canonical vocabulary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspan.functions import text

# Index and name in the 80-class model, canonical class id, canonical class name.
CANONICAL = """\
0,person,/m/01g317,Person
1,bicycle,/m/0199g,Bicycle
2,car,/m/0k4j,Car
3,motorcycle,/m/04_sv,Motorcycle
4,airplane,/m/0cmf2,Airplane
5,bus,/m/01bjv,Bus
6,train,/m/07jdr,Train
7,truck,/m/07r04,Truck
8,boat,/m/019jd,Boat
9,traffic light,/m/015qff,Traffic light
10,fire hydrant,/m/01pns0,Fire hydrant
11,stop sign,/m/02pv19,Stop sign
12,parking meter,/m/015qbp,Parking meter
13,bench,/m/0cvnqh,Bench
14,bird,/m/015p6,Bird
15,cat,/m/01yrx,Cat
16,dog,/m/0bt9lr,Dog
17,horse,/m/03k3r,Horse
18,sheep,/m/07bgp,Sheep
19,cow,/m/01xq0k1,Cattle
20,elephant,/m/0bwd_0j,Elephant
21,bear,/m/01dws,Bear
22,zebra,/m/0898b,Zebra
23,giraffe,/m/03bk1,Giraffe
24,backpack,/m/01940j,Backpack
25,umbrella,/m/0hnnb,Umbrella
26,handbag,/m/080hkjn,Handbag
27,tie,/m/01rkbr,Tie
28,suitcase,/m/01s55n,Suitcase
29,frisbee,/m/02wmf,Flying disc
30,skis,/m/071p9,Ski
31,snowboard,/m/06__v,Snowboard
32,sports ball,/m/018xm,Ball
33,kite,/m/02zt3,Kite
34,baseball bat,/m/03g8mr,Baseball bat
35,baseball glove,/m/03grzl,Baseball glove
36,skateboard,/m/06_fw,Skateboard
37,surfboard,/m/019w40,Surfboard
38,tennis racket,/m/0h8my_4,Tennis racket
39,bottle,/m/04dr76w,Bottle
40,wine glass,/m/09tvcd,Wine glass
41,cup,/m/02p5f1q,Coffee cup
42,fork,/m/0dt3t,Fork
43,knife,/m/04ctx,Knife
44,spoon,/m/0cmx8,Spoon
45,bowl,/m/04kkgm,Bowl
46,banana,/m/09qck,Banana
47,apple,/m/014j1m,Apple
48,sandwich,/m/0l515,Sandwich
49,orange,/m/0cyhj_,Orange
50,broccoli,/m/0hkxq,Broccoli
51,carrot,/m/0fj52s,Carrot
52,hot dog,/m/01b9xk,Hot dog
53,pizza,/m/0663v,Pizza
54,donut,/m/0jy4k,Doughnut
55,cake,/m/0fszt,Cake
56,chair,/m/01mzpv,Chair
57,couch,/m/02crq1,Couch
58,potted plant,/m/03fp41,Houseplant
59,bed,/m/03ssj5,Bed
60,dining table,/m/0h8n5zk,Kitchen & dining room table
61,toilet,/m/09g1w,Toilet
62,tv,/m/07c52,Television
63,laptop,/m/01c648,Laptop
64,mouse,/m/04rmv,Mouse
65,remote,/m/0qjjc,Remote control
66,keyboard,/m/01m2v,Computer keyboard
67,cell phone,/m/050k8,Mobile phone
68,microwave,/m/0fx9l,Microwave oven
69,oven,/m/029bxz,Oven
70,toaster,/m/01k6s3,Toaster
71,sink,/m/0130jx,Sink
72,refrigerator,/m/040b_t,Refrigerator
73,book,/m/0bt_c3,Book
74,clock,/m/01x3z,Clock
75,vase,/m/02s195,Vase
76,scissors,/m/01lsmm,Scissors
77,teddy bear,/m/0kmg4,Teddy bear
78,hair drier,/m/03wvsk,Hair dryer
79,toothbrush,/m/012xff,Toothbrush
"""

# The indexes that tracking follows.
TRACKED = (0, 1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 17, 18, 19, 24, 25, 26, 28, 32, 36, 37)

_KINDS = "class_index int, model_name string, canonical_id string, canonical_name string"


def canonical_rows() -> list[tuple[int, str, str, str]]:
    return [(int(i), n, m, c) for i, n, m, c in (line.split(",") for line in CANONICAL.splitlines())]


def canonical_classes(spark: SparkSession) -> DataFrame:
    """(class_index, model_name, canonical_id, canonical_name): 80 rows."""
    return spark.createDataFrame(canonical_rows(), _KINDS)


def with_canonical(rows: DataFrame, index: str = "class_index") -> DataFrame:
    """Rows with canonical_id and canonical_name; an index outside the table fails the job."""
    known = canonical_classes(rows.sparkSession).withColumnRenamed("class_index", "_i")
    joined = rows.join(F.broadcast(known.drop("model_name")), F.col(index) == F.col("_i"), "left").drop("_i")
    bad = F.raise_error(F.concat(F.lit("unsupported class index "), F.col(index).cast("string"))).cast("string")
    return joined.withColumn("canonical_id", F.coalesce("canonical_id", bad))


def model_name_faults(spark: SparkSession, names: dict[int, str]) -> DataFrame:
    """(class_index, model_name, given): classes of a model that are missing, surplus or named otherwise."""
    given = spark.createDataFrame(list(names.items()), "class_index int, given string")
    both = canonical_classes(spark).select("class_index", "model_name").join(given, "class_index", "full")
    plain = lambda c: F.lower(F.trim(c))
    return both.where(~plain("model_name").eqNullSafe(plain("given")))


def check_model_names(spark: SparkSession, names: dict[int, str]) -> None:
    """Raise unless a model has exactly the expected classes."""
    wrong = model_name_faults(spark, names).orderBy("class_index").limit(5).collect()
    if wrong:
        raise ValueError(f"unexpected classes: {[tuple(r) for r in wrong]}")


def index_class_id(index: Column) -> Column:
    """cNNN of a class index from 0 to 999, else null."""
    return F.when(index.between(0, 999), F.format_string("c%03d", index))


def class_id_index(class_id: Column) -> Column:
    """The index in cNNN, or null."""
    return F.nullif(F.regexp_extract(class_id, r"\Ac(\d+)\z", 1), F.lit("")).cast("int")


def with_names(rows: DataFrame, classes: DataFrame, index: str = "class_index") -> DataFrame:
    """Rows with ``class_name`` from classes (class_index, class_name); unknown indexes become class_<index>.

    The vocabulary is joined without a hint: its size decides the strategy.
    """
    named = classes.select(F.col("class_index").alias("_i"), F.col("class_name"))
    return rows.join(named, F.col(index) == F.col("_i"), "left").withColumn("class_name", F.coalesce("class_name", F.concat(F.lit("class_"), F.col(index).cast("string")))).drop("_i")


def indices_of(classes: DataFrame, names: list[str]) -> DataFrame:
    """One row: the sorted indexes of the named classes; an unknown name raises."""
    spark = classes.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "name string").select(text.class_name(F.col("name")).alias("k")).distinct()
    known = classes.select(text.class_name(F.col("class_name")).alias("k"), "class_index")
    gone = [r["k"] for r in wanted.join(known, "k", "left_anti").limit(10).collect()]
    if gone:
        raise ValueError(f"unknown classes: {gone}")
    return wanted.join(known, "k").agg(F.array_sort(F.collect_set("class_index")).alias("indices"))


def canonical_sql() -> str:
    values = ", ".join(f"({i}, '{n}', '{m}', '{c}')" for i, n, m, c in canonical_rows())
    return f"(VALUES {values}) AS k(class_index, model_name, canonical_id, canonical_name)"


def union_all(*parts: DataFrame) -> DataFrame:
    """Record streams of different columns as one; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
