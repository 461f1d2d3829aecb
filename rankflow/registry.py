"""Feature registry: which columns exist, how they are encoded and which vocabulary they share.

The registry is driver-side metadata only.  `Registry.spec_df` turns it into a
DataFrame where a query needs to join against it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EMBEDDING_DIM = 16

# Slot id, column, vocabulary, capacity (id 0 included).
SPARSE = """
0 book_id bid 10001
1 gender gender 11
2 hour hour 25
3 week_day week_day 8
4 month_day month_day 32
5 m_media_source m_media_source 101
6 mbid bid 10001
7 prov prov 501
8 language language 201
9 syslangu language 201
10 book_language language 201
11 brand brand 4001
12 os os_type 6
13 is_login is_login 4
14 vip_type is_vip 4
15 gap_day gap_day 200
16 m_adtype m_adtype 50
17 time_zone time_zone 50
18 apn apn 50
19 videoQaGrade videoQaGrade 10
20 b_gender b_gender 10
21 b_maketype b_maketype 20
22 mb_gender mb_gender 10
23 mb_maketype mb_maketype 20
24 countryMakeType countryMakeType 1000
25 osMbGenderBGender osMbGenderBGender 150
26 osMbGenderBMaketype osMbGenderBMaketype 200
27 osMbMaketypeBGender osMbMaketypeBGender 200
28 osMbMaketypeBMaketype osMbMaketypeBMaketype 500
29 provMbGenderBGender provMbGenderBGender 5000
30 provMbGenderBMaketype provMbGenderBMaketype 5000
31 provMbMaketypeBGender provMbMaketypeBGender 5000
32 provMbMaketypeBMaketype provMbMaketypeBMaketype 5000
33 genderMbGenderBGender genderMbGenderBGender 150
34 genderMbGenderBMaketype genderMbGenderBMaketype 250
35 genderMbMaketypeBGender genderMbMaketypeBGender 250
36 genderMbMaketypeBMaketype genderMbMaketypeBMaketype 500
37 vipTypeMbGenderBGender vipTypeMbGenderBGender 150
38 vipTypeMbGenderBMaketype vipTypeMbGenderBMaketype 250
39 vipTypeMbMaketypeBGender vipTypeMbMaketypeBGender 500
40 vipTypeMbMaketypeBMaketype vipTypeMbMaketypeBMaketype 500
41 mMediaSourceMbGenderBGender mMediaSourceMbGenderBGender 250
42 mMediaSourceMbGenderBMaketype mMediaSourceMbGenderBMaketype 500
43 mMediaSourceMbMaketypeBGender mMediaSourceMbMaketypeBGender 500
44 mMediaSourceMbMaketypeBMaketype mMediaSourceMbMaketypeBMaketype 500
46 uVipLabel uVipLabel 20
47 pAppVersion pAppVersion 50
48 produceCountry produceCountry 20
49 userid userid 10000000
"""

# Slot id, column, vocabulary, capacity, list length.
SEQUENCE = """
2000 tag_set tagv3 1001 10
2001 top_prefer_tag tagv3 1001 10
2002 userWatchBookListLatestBookId bid 10001 20
2003 userFollowBookListLatestBookId bid 10001 20
2004 userAttributeBookListLatestBookId bid 10001 20
2005 userClickBookListLatestBookId bid 10001 20
2006 index_discover_click_seq bid 10001 20
2007 index_collection_click_seq bid 10001 20
2008 index_profile_click_seq bid 10001 20
2009 rank_click_seq bid 10001 20
2010 index_foru_click_seq bid 10001 20
2011 watch_history_click_seq bid 10001 20
2012 search_click_seq bid 10001 20
2013 userFullWatchBookListLatestBookId bid 10001 20
2014 userBuyBookListLatestBookId bid 10001 20
2015 userOnlyUnFollowBookListLatestBookId bid 10001 20
2016 userUnclickBookListLatest bid 10001 20
2017 userWatchBookListLatestGapDay gap_day 201 20
2018 userFollowBookListLatestGapDay gap_day 201 20
2019 userAttributeBookListLatestGapDay gap_day 201 20
2020 userClickBookListLatestGapDay gap_day 201 20
2021 userFullWatchBookListLatestGapDay gap_day 201 20
2022 userBuyBookListLatestGapDay gap_day 201 20
2023 userOnlyUnFollowBookListLatestGapDay gap_day 201 20
2024 userWatchBookListLatestGender gender 11 20
2025 userFollowBookListLatestGender gender 11 20
2026 userAttributeBookListLatestGender gender 11 20
2027 userClickBookListLatestGender gender 11 20
2028 userFullWatchBookListLatestGender gender 11 20
2029 userBuyBookListLatestGender gender 11 20
2030 userOnlyUnFollowBookListLatestGender gender 11 20
2031 userFreeFullWatchBookListLatestBookId bid 10001 20
2032 userFreeFullWatchBookListLatestGapDay gap_day 201 20
2033 userFreeFullWatchBookListLatestGender gender 11 20
2034 userLastWatchBookListBookId bid 10001 20
2035 userLastWatchBookListGapDay gap_day 201 20
2036 userLastWatchBookListGender gender 11 20
2037 userWatchBookListGt5EpdBookId bid 10001 20
2038 userWatchBookListGt5EpdGapDay gap_day 201 20
2039 userWatchBookListGt5EpdGender gender 11 20
2040 userWatchBookListGt10EpdBookId bid 10001 20
2041 userWatchBookListGt10EpdGapDay gap_day 201 20
2042 userWatchBookListGt10EpdGender gender 11 20
2043 userFullWatchBookListLatestCheckedBookId bid 10001 20
2044 userFullWatchBookListLatestCheckedGapDay gap_day 201 20
2045 userFullWatchBookListLatestCheckedGender gender 11 20
2046 userLatestVideoListId play_id 10001 50
2047 userLatestVideoListGapDay play_gap 201 50
2048 userLatestVideoListLabels play_label 1001 50
"""

# Slot id, column, number of ranks kept.
RANK = """
3000 mchid 1000
3001 model 1000
"""

# Position column and its highest value.
POSITION = ("book_pos", 60)

# The dense columns the score gates read, and a few short ones.  The
# other dense columns come in as a parameter, see `Registry.with_dense` and
# `load_dense_spec`.
DENSE = {
    1000: ("chapter_number", range(1, 200)),
    1001: ("total_chapter_num", [20, 30, 40, 50, 60, 70, 80, 90, 100, 120, 150, 200]),
    1002: ("free_chapter_num", range(1, 40)),
    1003: ("shelf_days", [0, 1, 2, 3, 5, 10, 15, 19, 32, 44, 76, 119, 140, 166, 265]),
    1004: ("register_days", [0, 1, 4, 14, 29, 65, 123, 192, 266, 400]),
    1014: ("click_pv_7days", [0, 825, 1956, 3412, 5492, 7805, 10115, 13338, 16979, 21191,
                              26829, 33670, 43341, 52920, 64285, 75536, 99512, 128105,
                              202368, 294904]),
    1200: ("userItemWatchLeftForPay", [
        -1.0, 2.14, 5.28, 8.42, 11.56, 14.700000000000001, 17.84, 20.98, 24.12,
        27.259999999999998, 30.400000000000002, 33.54, 36.68, 39.82, 42.96, 46.1, 49.24, 52.38,
        55.519999999999996, 58.660000000000004, 61.800000000000004, 64.94, 68.08, 71.22, 74.36,
        77.5, 80.64, 83.78, 86.92, 90.05999999999999, 93.2, 96.34, 99.48, 102.62, 105.76, 108.9,
        112.03999999999999, 115.17999999999999, 118.32000000000001, 121.46000000000001,
        124.60000000000001, 127.74000000000001, 131.88, 136.02, 139.32, 144.3, 147.44, 153.58,
        158.44, 161.85999999999999, 165.0]),
    1207: ("page", range(20)),
    1208: ("ad_gap_min", [*range(60), 120, 180, 240, 480, 720, 1384, 2273, 3501, 5484, 7929,
                          10580, 13957, 19481, 26189, 33947, 47137, 63976, 95023, 175583]),
    1209: ("register_min", [*range(60), 78, 1525, 5573, 12120, 23016, 36617, 53250, 71144,
                            100978, 146233, 189647, 245169, 298543, 342054, 406645, 502405,
                            601024, 702995]),
    1225: ("activeDay", [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 15, 20, 26, 33, 43, 55, 72,
                         96, 133, 192, 292]),
    1226: ("activeDays7d", range(8)),
    1227: ("activeDays30d", range(31)),
}

# Label columns, integer-typed scalars, score gates, attention query,
# the behaviours whose three lists form the attention keys, and the gap vocabularies.
LABELS = ["ctr_label", "cvr_label", "vip_label", "unlock_label", "finish_view_label"]
INT_SPARSE = ["week_day", "hour", "month_day", "pAppVersion"]
GATES = ["language", "book_language", "vip_type", "shelf_days", "register_min", "click_pv_7days",
         "prov", "page", "ad_gap_min", "uVipLabel", "activeDay", "activeDays7d"]
QUERY = ["book_id", "gender", "gap_day"]
BEHAVIOURS = ["userWatchBookListLatest", "userFollowBookListLatest", "userAttributeBookListLatest",
              "userClickBookListLatest", "userFullWatchBookListLatest", "userBuyBookListLatest",
              "userOnlyUnFollowBookListLatest", "userFreeFullWatchBookListLatest",
              "userLastWatchBookList", "userWatchBookListGt5Epd", "userWatchBookListGt10Epd",
              "userFullWatchBookListLatestChecked"]
BEHAVIOUR_PARTS = ["BookId", "GapDay", "Gender"]
GAP_VOCABULARIES = ("gap_day", "play_gap")

# The parts that crossed features are named after (a request's, a user's, a book's).
CROSSED_REQUEST = {"os": "os", "prov": "prov", "gender": "gender", "vipType": "vip_type", "mMediaSource": "m_media_source"}
CROSSED_USER = {"MbGender": "mb_gender", "MbMaketype": "mb_maketype"}
CROSSED_BOOK = {"BGender": "b_gender", "BMaketype": "b_maketype"}

_GROUPS = ("sparse", "dense", "sequence", "rank", "position")


@dataclass(frozen=True)
class Feature:
    slot_id: int
    name: str
    group: str
    emb_name: str
    vocab_size: int
    maxlen: int = 1
    boundaries: tuple[float, ...] = ()


class Registry:
    """Features in slot order; names resolve without regard to case."""

    def __init__(self, features: Iterable[Feature]):
        self.features = sorted(features, key=lambda f: (f.group == "position", f.slot_id))
        self._by_name = {f.name.lower(): f for f in self.features}
        if len(self._by_name) != len(self.features):
            raise ValueError("two features differ only by case")

    def __getitem__(self, name: str) -> Feature:
        try:
            return self._by_name[name.lower()]
        except KeyError:
            raise KeyError(f"unknown feature {name!r}") from None

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._by_name

    def names(self, *groups: str) -> list[str]:
        return [f.name for f in self.group(*groups)]

    def group(self, *groups: str) -> list[Feature]:
        return [f for f in self.features if not groups or f.group in groups]

    def subset(self, names: Sequence[str]) -> "Registry":
        return Registry(self[n] for n in names)

    def present_in(self, columns: Sequence[str]) -> "Registry":
        have = {c.lower() for c in columns}
        return Registry(f for f in self.features if f.name.lower() in have)

    def with_dense(self, spec: Iterable[tuple[int, str, Sequence[float]]]) -> "Registry":
        """Replace or add dense features given as (slot id, column, boundaries)."""
        new = [dense_feature(*row) for row in spec]
        taken = {f.name.lower() for f in new}
        return Registry([f for f in self.features if f.name.lower() not in taken] + new)

    def capacities(self) -> dict[str, int]:
        """Vocabulary -> capacity: the largest of the members that share it."""
        out: dict[str, int] = {}
        for f in self.group("sparse", "sequence"):
            out[f.emb_name] = max(out.get(f.emb_name, 0), f.vocab_size)
        return out

    def gate_features(self) -> list[str]:
        return [self[n].name for n in GATES]

    def query_features(self) -> list[str]:
        return [self[n].name for n in QUERY]

    def history_features(self) -> list[str]:
        return [self[b + p].name for b in BEHAVIOURS for p in BEHAVIOUR_PARTS]

    def pooled_sequences(self) -> list[str]:
        history = set(self.history_features())
        return [n for n in self.names("sequence") if n not in history]

    def spec_df(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([
            T.StructField("slot_id", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("kind", T.StringType()),
            T.StructField("vocab_size", T.IntegerType()),
            T.StructField("emb_name", T.StringType()),
            T.StructField("maxlen", T.IntegerType()),
            T.StructField("boundaries", T.ArrayType(T.DoubleType())),
        ])
        rows = [(f.slot_id, f.name, f.group, f.vocab_size, f.emb_name, f.maxlen,
                 list(f.boundaries)) for f in self.features]
        return spark.createDataFrame(rows, schema)


def crossed_features() -> dict[str, tuple[str, str, str]]:
    """Name of every crossed feature and the three columns it is made of."""
    return {r + u + b: (request, user, book) for r, request in CROSSED_REQUEST.items()
            for u, user in CROSSED_USER.items() for b, book in CROSSED_BOOK.items()}


def dense_feature(slot_id: int, name: str, boundaries: Sequence[float]) -> Feature:
    cuts = tuple(float(b) for b in boundaries)
    if list(cuts) != sorted(cuts):
        raise ValueError(f"boundaries of {name} are not sorted")
    return Feature(slot_id, name, "dense", name, len(cuts) + 1, boundaries=cuts)


def load_dense_spec(spark: SparkSession, path: str) -> list[tuple[int, str, list[float]]]:
    """Read {"slot_id", "name", "boundaries"} objects for `with_dense`, one or a list of them per line, wherever Spark can read.

    There is one row per feature, a few hundred in all.
    """
    rows = spark.read.schema("slot_id int, name string, boundaries array<double>").json(path).collect()
    return sorted((r.slot_id, r.name, r.boundaries) for r in rows)


def default_registry() -> Registry:
    rows: list[Feature] = []
    for line in SPARSE.split("\n"):
        if line:
            slot, name, emb, size = line.split()
            rows.append(Feature(int(slot), name, "sparse", emb, int(size)))
    for line in SEQUENCE.split("\n"):
        if line:
            slot, name, emb, size, maxlen = line.split()
            rows.append(Feature(int(slot), name, "sequence", emb, int(size), int(maxlen)))
    for line in RANK.split("\n"):
        if line:
            slot, name, top = line.split()
            rows.append(Feature(int(slot), name, "rank", name, int(top) + 1))
    rows += [dense_feature(slot, *spec) for slot, spec in DENSE.items()]
    name, top = POSITION
    rows.append(Feature(0, name, "position", name, top + 1))
    return Registry(rows)
