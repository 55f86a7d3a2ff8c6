"""Values a harmonised result must contain exactly.

Nothing here is logic. Jobs take these as default arguments, so another survey
passes its own.
"""

# --- fixed values: dataset provenance, one entry per survey ------------------
DATASETS = {
    "birds_1974": {
        "dataset_name": "Data for: Bird communities in relation to the structure of urban habitats",
        "dataset_creator": "Richard Landcaster",
        "dataset_publisher": "Borealis",
        "dataset_url_information": "https://borealisdata.ca/dataset.xhtml?persistentId=doi:10.5683/SP2/YD6N7C",
        "dataset_url_download": None,
        "dataset_doi": "10.5683/SP2/YD6N7C",
        "license": "CC0 1.0",
        "observation_type": "density_ha",
        "group": "Aves",
    },
    "birds_2000": {
        "dataset_name": "Data for: Effects of landscape and local habitat features on bird communities: a study of urban gradient in greater Vancouver.",
        "dataset_creator": "Melles, Stephanie J.",
        "dataset_publisher": "Borealis",
        "dataset_url_information": "https://borealisdata.ca/dataset.xhtml?persistentId=doi:10.5683/SP2/BPLPAP",
        "dataset_url_download": None,
        "dataset_doi": "10.5683/SP2/BPLPAP",
        "license": "CC0 1.0",
        "observation_type": "abundance",
        "group": "Birds",
    },
    # Title and creator of this survey are not known; only its identifier is.
    "birds_1967": {
        "dataset_name": None,
        "dataset_creator": None,
        "dataset_publisher": "Borealis",
        "dataset_url_information": "https://borealisdata.ca/dataset.xhtml?persistentId=doi:10.5683/SP2/K5LMLA",
        "dataset_url_download": None,
        "dataset_doi": "10.5683/SP2/K5LMLA",
        "license": "CC0 1.0",
        "observation_type": "abundance",
        "group": "Birds",
    },
    "salamanders": {
        "dataset_name": "Population Survey Data for Coastal Giant Salamanders in the Chilliwack River Valley",
        "dataset_creator": "John Richardson",
        "dataset_publisher": "Borealis",
        "dataset_url_information": "https://borealisdata.ca/dataset.xhtml?persistentId=doi:10.5683/SP3/7MH2AM",
        "dataset_url_download": None,
        "dataset_doi": "10.5683/SP3/7MH2AM",
        "license": "CC-BY-4.0",
        "observation_type": "occurrence",
        "group": "Amphibians",
        "vernacular": "Coastal Giant Salamander",
        "valid_scientific_name": "Dicamptodon tenebrosus",
    },
}

# --- fixed values: season -> (month, day) in the middle of the season ---------
SEASON_CALENDAR = {"Spring": (5, 6), "Summer": (7, 13), "Autumn": (9, 23), "Winter": (1, 15)}

# --- fixed values: rows of the wide census that are not a species -------------
WIDE_CENSUS_SKIP = ["Total", "BT"]
WIDE_CENSUS_SITE_PREFIX = "Lancaster_"

# --- fixed values: species codes of the long census --------------------------
SPECIES_CODE_FIXES = {"WIWA (7 NOTES)": "WIWA", "RCKI OR GCKI?": "RCKI", "RSTO": "SPTO"}
EXTRA_SPECIES = [("GULL", "Larus spp.", "Gull")]

# --- fixed values: site names of the plot census -----------------------------
PLOT_NAMES = {
    "weber1": "19th_Yukon",
    "weber2": "14th_Spruce",
    "weber3": "43rd_Churchill",
    "weber4": "Ferguson_Road",
    "weber5": "F_21st",
    "weber6": "S_24th",
}

# --- fixed values: corrections in the stream survey --------------------------
STREAM_NAME_FIXES = {"Nes19d": "Nes19"}
LOCATION_FIXES = {".": "0", "O": "0", "minus 5": "-5"}

# --- fixed values: metres of position error ----------------------------------
GPS_ERROR_M = 10.0
# --- fixed values: the wide census counts birds per 40 ha ---------------------
CENSUS_AREA_HA = 40.0

# --- fixed values: earlier downloads that may be used again -------------------
REQUEST_STATUS = "SUCCEEDED"
REQUEST_SOURCE = "rgbif"
REUSE_DAYS = 30

# fixed values: points and sites that the long census leaves out
LEFT_OUT_POINT = "edge pt"
LEFT_OUT_NAMES = "omit"
LEFT_OUT_NUMBER = "44a"
