"""Property classes, names and inverses, as sets and as a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Properties by class, their names and inverses.
#: Relations that may be causes, with their names.
NAMES = {
    "P22": "father",
    "P25": "mother",
    "P40": "child",
    "P50": "author",
    "P57": "director",
    "P58": "screenwriter",
    "P61": "discoverer or inventor",
    "P86": "composer",
    "P112": "founded by",
    "P138": "named after",
    "P144": "based on",
    "P155": "follows",
    "P156": "followed by",
    "P161": "cast member",
    "P162": "producer",
    "P167": "structure replaced by",
    "P170": "creator",
    "P175": "performer",
    "P176": "manufacturer",
    "P178": "developer",
    "P184": "doctoral advisor",
    "P185": "doctoral student",
    "P272": "production company",
    "P279": "subclass of",
    "P287": "designed by",
    "P344": "director of photography",
    "P710": "participant",
    "P737": "influenced by",
    "P800": "notable work",
    "P802": "student",
    "P828": "has cause",
    "P941": "inspired by",
    "P1040": "film editor",
    "P1066": "student of",
    "P1344": "participant of",
    "P1365": "replaces",
    "P1366": "replaced by",
    "P1431": "executive producer",
    "P1478": "has immediate cause",
    "P1479": "has contributing factor",
    "P1536": "immediate cause of",
    "P1537": "contributing factor of",
    "P1542": "cause of",
    "P2515": "costume designer",
    "P2554": "production designer",
    "P3092": "film crew member",
    "P3448": "stepparent",
    "P5191": "derived from",
    "P6338": "colorist",
}
CAUSAL = frozenset(NAMES)
#: Times at which something begins.
STARTS = frozenset({"P569", "P571", "P575", "P577", "P580", "P729", "P1191", "P1319", "P1619", "P2031", "P3999", "P6949"})
#: Times at which something ends.
ENDS = frozenset({"P570", "P576", "P582", "P730", "P746", "P1326", "P2032", "P2669", "P3999"})
#: Points in time.
POINTS = frozenset({"P585", "P1317"})
#: Every property whose value is a time.
TIMES = frozenset(
    {
        "P523", "P524", "P556", "P569", "P570", "P571", "P575", "P576", "P577", "P580", "P582", "P585",
        "P606", "P607", "P729", "P730", "P746", "P748", "P749", "P813", "P837", "P859", "P1191", "P1249",
        "P1317", "P1319", "P1326", "P1389", "P1619", "P1636", "P1734", "P2031", "P2032", "P2285", "P2286", "P2610",
        "P2669", "P2754", "P2755", "P2756", "P2894", "P2895", "P2913", "P2960", "P3415", "P3893", "P3999", "P4282",
        "P4283", "P4602", "P4733", "P4734", "P6207", "P6208", "P6257", "P6555", "P6556", "P6949", "P7103", "P7104",
        "P7124", "P7125", "P7506", "P7507", "P7584", "P7585", "P7588", "P7589", "P8556", "P8557", "P9714", "P9715",
    }
)
#: Statements whose qualifiers date them.
DATED = frozenset({"P26", "P69", "P106", "P108", "P348", "P449", "P793", "P1891"})
TIMES_AND_DATED = TIMES | DATED
UNSPECIFIC = frozenset({"P828", "P1478", "P1479", "P1536", "P1537", "P1542"})
LEXEME_TO_LEXEME = frozenset({"P5191", "P5238", "P6571"})
LEXEME_TO_ITEM = frozenset({"P5137", "P6684"})
SENSE_TO_ITEM = frozenset({"P5137", "P6684", "P9970"})
SENSE_TO_SENSE = frozenset({"P5972", "P5973", "P5974", "P5975", "P6593", "P8471", "P12410"})
INVERSES = {
    "P22": "P40",
    "P25": "P40",
    "P40": "P22",
    "P155": "P156",
    "P156": "P155",
    "P184": "P185",
    "P185": "P184",
    "P710": "P1344",
    "P802": "P1066",
    "P828": "P1542",
    "P1066": "P802",
    "P1344": "P710",
    "P1365": "P1366",
    "P1366": "P1365",
    "P1478": "P1536",
    "P1479": "P1537",
    "P1536": "P1478",
    "P1537": "P1479",
    "P1542": "P828",
}
#: Properties without an inverse of their own get one marked by an i.
ALL_INVERSES = INVERSES | {x: y for p in CAUSAL - set(INVERSES) - {"P167"} for x, y in ((p, p + "i"), (p + "i", p))}

#: Languages in which a label is looked for first.
LABEL_ORDER = ("en", "de", "fr", "es", "it", "pl", "pt", "nl", "sv", "no", "fi", "ro")


def dimension(spark: SparkSession) -> DataFrame:
    """One row for each classified property."""
    every = CAUSAL | TIMES_AND_DATED | LEXEME_TO_LEXEME | SENSE_TO_ITEM | SENSE_TO_SENSE
    rows = [(p, NAMES.get(p), p in CAUSAL, p in STARTS, p in ENDS, p in TIMES, p in DATED, p in UNSPECIFIC, ALL_INVERSES.get(p)) for p in sorted(every, key=lambda p: int(p[1:]))]
    return spark.createDataFrame(rows, "prop string, name string, is_causal boolean, is_start boolean, is_end boolean, is_time boolean, is_dated boolean, is_unspecific boolean, inverse string")
