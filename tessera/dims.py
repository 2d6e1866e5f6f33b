"""Dictionaries: classes, states, relation types and roles, words of names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes of the classes that the engine's own rules name.
CLASS_CODES = {
    "class:none": 0,
    "barrier:yes": 179,
    "boundary:national_park": 183,
    "boundary:protected_area": 187,
    "building:yes": 252,
    "highway:motorway": 344,
    "highway:motorway_junction": 375,
    "historic:yes": 417,
    "landuse:winter_sports": 444,
    "man_made:yes": 535,
    "office:yes": 624,
    "tourism:yes": 965,
    "boundary:state": 996,
    "boundary:national_park2": 997,
    "boundary:national_monument3": 998,
    "piste:downhill0": 1002,
    "piste:downhill1": 1003,
    "piste:downhill2": 1004,
    "piste:downhill3": 1005,
    "piste:downhill4": 1006,
    "piste:nordic": 1007,
}
#: Classes that any other class of the same feature replaces, as buildings do.
GENERIC = ("class:none", "building:yes", "barrier:yes", "office:yes", "historic:yes", "man_made:yes", "tourism:yes")
#: The first code given to classes that only a style sheet or a dictionary file names.
FIRST_FREE = 1008


class Classes:
    """A dictionary of classes "key:value". Codes come from a dictionary file (one class a line, its code the line's
    number from 0), or else from the rules' own classes followed by the others in order of name."""

    def __init__(self, names: Iterable[str] = (), listed: list[str] | None = None):
        if listed is not None:
            self.codes = {n: k for k, n in enumerate(listed)}
            missing = sorted(set(CLASS_CODES) - set(self.codes))
            self.codes |= {n: len(listed) + k for k, n in enumerate(missing)}
        else:
            extra = sorted(set(names) - set(CLASS_CODES))
            self.codes = CLASS_CODES | {n: FIRST_FREE + k for k, n in enumerate(extra)}
        self.names = {c: n for n, c in self.codes.items()}

    @staticmethod
    def read(spark: SparkSession, path: str) -> Classes:
        """From a dictionary file, which may lie wherever Spark can read."""
        text = spark.read.text(path, wholetext=True).first()
        return Classes(listed=[line.strip() for line in (text[0] if text else "").splitlines() if line.strip()])

    def __getitem__(self, name: str) -> int:
        return self.codes[name]

    def code(self, key: str, value: str) -> int:
        """The code of a tag; 0 if it names no class."""
        return self.codes.get(f"{key}:{value}", 0)

    def name(self, code: int) -> str | None:
        return self.names.get(code)

    def is_building(self, code: int) -> bool:
        return self.names.get(code, "").startswith("building:")

    def is_boundary(self, code: int) -> bool:
        return self.names.get(code, "").startswith("boundary:")

    def is_core(self, code: int) -> bool:
        return self.names.get(code, "").startswith("core:")

    def __len__(self) -> int:
        return len(self.codes)

    def rows(self) -> list[tuple[int, str, str, bool, bool, bool]]:
        split = ((c, *n.partition(":")[::2]) for n, c in sorted(self.codes.items(), key=lambda x: x[1]))
        return [(c, k, v, self.is_building(c), self.is_boundary(c), self.is_core(c)) for c, k, v in split]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "code int, key string, value string, is_building boolean, is_boundary boolean, is_core boolean")


# FIPS code, abbreviation and name of the states.
STATES = (
    (1, "AL", "Alabama"), (2, "AK", "Alaska"), (4, "AZ", "Arizona"), (5, "AR", "Arkansas"), (6, "CA", "California"),
    (8, "CO", "Colorado"), (9, "CT", "Connecticut"), (10, "DE", "Delaware"), (11, "DC", "District of Columbia"),
    (12, "FL", "Florida"), (13, "GA", "Georgia"), (15, "HI", "Hawaii"), (16, "ID", "Idaho"), (17, "IL", "Illinois"),
    (18, "IN", "Indiana"), (19, "IA", "Iowa"), (20, "KS", "Kansas"), (21, "KY", "Kentucky"), (22, "LA", "Louisiana"),
    (23, "ME", "Maine"), (24, "MD", "Maryland"), (25, "MA", "Massachusetts"), (26, "MI", "Michigan"),
    (27, "MN", "Minnesota"), (28, "MS", "Mississippi"), (29, "MO", "Missouri"), (30, "MT", "Montana"),
    (31, "NE", "Nebraska"), (32, "NV", "Nevada"), (33, "NH", "New Hampshire"), (34, "NJ", "New Jersey"),
    (35, "NM", "New Mexico"), (36, "NY", "New York"), (37, "NC", "North Carolina"), (38, "ND", "North Dakota"),
    (39, "OH", "Ohio"), (40, "OK", "Oklahoma"), (41, "OR", "Oregon"), (42, "PA", "Pennsylvania"),
    (44, "RI", "Rhode Island"), (45, "SC", "South Carolina"), (46, "SD", "South Dakota"), (47, "TN", "Tennessee"),
    (48, "TX", "Texas"), (49, "UT", "Utah"), (50, "VT", "Vermont"), (51, "VA", "Virginia"), (53, "WA", "Washington"),
    (54, "WV", "West Virginia"), (55, "WI", "Wisconsin"), (56, "WY", "Wyoming"),
)


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, "code int, abbreviation string, name string")


def with_states(df: DataFrame, code: str = "code") -> DataFrame:
    """Adds abbreviation and name of the state with the code; empty texts where there is none."""
    named = states(df.sparkSession).select(F.col("code").alias(code), "abbreviation", F.col("name").alias("state"))
    return df.join(F.broadcast(named), code, "left").fillna("", ["abbreviation", "state"])


def state_code(text: str) -> int:
    """The code of a state's name or (in any case) abbreviation; 0 if unknown."""
    return next((c for c, a, n in STATES if n == text or a == text.upper()), 0)


def state_name(code: int) -> str | None:
    return next((n for c, _, n in STATES if c == code), None)


def state_abbreviation(code: int) -> str | None:
    return next((a for c, a, _ in STATES if c == code), None)


# Words of names that keep a small first letter.
SMALL_WORDS = frozenset(
    "a an and at by cdt du e el em en de del des ft for in l la las ll los n nd near o on of our rd s st t th the to via with y".split()
)

# Abbreviations of words of names.
ABBREVIATIONS = {
    "North": "N",
    "East": "E",
    "South": "S",
    "West": "W",
    "Northeast": "NE",
    "Northwest": "NW",
    "Southeast": "SE",
    "Southwest": "SW",
    "Avenue": "Ave",
    "Boulevard": "Blvd",
    "Court": "Ct",
    "Circle": "Cir",
    "Drive": "Dr",
    "Expressway": "Expwy",
    "Freeway": "Fwy",
    "Highway": "Hwy",
    "Lane": "Ln",
    "Parkway": "Pkwy",
    "Place": "Pl",
    "Road": "Rd",
    "Street": "St",
    "Terrace": "Ter",
    "Trail": "Tr",
    "Mount": "Mt",
    "Mt.": "Mt",
    "Mountain": "Mtn",
    "Trailhead": "TH",
    "Building": "Bldg",
    "Campground": "CG",
}

# Sampling regions as (latT, lonL, latB, lonR).
REGIONS = {
    "WW": (90.0, -180.0, -90.0, 180.0),
    "US": (51.0, -126.0, 23.0, -64.0),
    "CO": (43.0, -110.0, 34.0, -100.0),
}
