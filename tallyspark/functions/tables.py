"""Tables of states: regional groups, their labels, small states' places on the map, and named sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The regional groups of the United Nations by ISO codes, former states included (Cyprus, Turkey's and
#: Israel's groups as the catalogue has them).
GROUPS = {
    "WEOG": """AND AUS AUT BEL CAN DNK FIN FRA DEU GER GRC ISL IRL ISR ITA LIE LUX MLT MCO
        NLD NZL NOR PRT SMR ESP SWE CHE TUR GBR USA""",
    "EEG": """ALB ARM AZE BLR BIH BGR HRV CZE CSK EST GEO HUN LVA LTU MNE MKD POL MDA
        ROU RUS SRB SVK SVN UKR YUG DDR SUN""",
    "GRULAC": """ATG ARG BHS BRB BLZ BOL BRA CHL COL CRI CUB DMA DOM ECU SLV GRD GTM GUY
        HTI HND JAM MEX NIC PAN PRY PER KNA LCA VCT SUR TTO URY VEN""",
    "AFRICAN": """DZA AGO BEN BWA BFA BDI CPV CMR CAF TCD COM COG COD CIV DJI EGY GNQ ERI
        SWZ ETH GAB GMB GHA GIN GNB KEN LSO LBR LBY MDG MWI MLI MRT MUS MAR MOZ
        NAM NER NGA RWA STP SEN SYC SLE SOM ZAF SSD SDN TGO TUN UGA TZA ZMB ZWE""",
    "ASIA_PACIFIC": """AFG BHR BGD BTN BRN KHM CHN CYP PRK FJI IND IDN IRN IRQ JPN JOR KAZ
        KWT KGZ LAO LBN MYS MDV MHL FSM MNG MMR NRU NPL OMN PAK PLW PNG PHL
        QAT KOR SAU SGP SLB LKA SYR TJK THA TLS TON TKM TUV ARE UZB VUT VNM
        YEM WSM KIR""",
}
#: What the groups are called; "" is for states without one.
LABELS = {
    "WEOG": "Western Europe & Others",
    "EEG": "Eastern Europe",
    "GRULAC": "Latin America & Caribbean",
    "AFRICAN": "African",
    "ASIA_PACIFIC": "Asia-Pacific",
    "": "Other/Unassigned",
}
#: Longitude and latitude of voters that the map has no shape of.
DOTS = {
    "MDV": (73.5, 4.2), "MUS": (57.55, -20.3), "BHR": (50.55, 26.05), "SGP": (103.8, 1.35), "CPV": (-23.6, 15.1), "COM": (43.3, -11.7),
    "STP": (6.6, 0.2), "SYC": (55.45, -4.6), "ATG": (-61.8, 17.1), "BRB": (-59.55, 13.15), "GRD": (-61.7, 12.1), "LCA": (-61.0, 13.9),
    "VCT": (-61.2, 13.25), "KNA": (-62.7, 17.3), "DMA": (-61.35, 15.4), "WSM": (-172.1, -13.75), "TON": (-175.2, -21.2), "FJI": (178.0, -17.8),
    "MLT": (14.4, 35.9), "BHS": (-77.4, 24.25), "MCO": (7.4, 43.7), "AND": (1.5, 42.5), "LIE": (9.55, 47.15), "SMR": (12.45, 43.95),
    "LUX": (6.13, 49.61), "MHL": (171.2, 7.1), "KIR": (173.0, 1.4), "FSM": (158.2, 6.9), "NRU": (166.9, -0.5), "PLW": (134.5, 7.5),
    "TUV": (179.2, -8.5), "SLB": (160.0, -9.6), "VUT": (167.0, -16.0),
}
#: The permanent members of the Security Council.
PERMANENT = "CHN FRA GBR RUS USA"


def groups(spark: SparkSession) -> DataFrame:
    """iso3 and grp of every state that is in a group."""
    return spark.createDataFrame([(iso, g) for g, names in GROUPS.items() for iso in names.split()], "iso3 string, grp string")


def dots(spark: SparkSession) -> DataFrame:
    """iso3, lon and lat."""
    return spark.createDataFrame([(iso, *at) for iso, at in DOTS.items()], "iso3 string, lon double, lat double")
