"""Fixed values of the normalisation rules."""

from __future__ import annotations

# Words of legal forms and the form each stands for.
LEGAL = {
    "llc": "llc", "pllc": "pllc", "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp",
    "co": "co", "company": "co", "ltd": "ltd", "limited": "ltd", "pvt": "pvt", "private": "pvt", "llp": "llp",
    "lp": "lp", "plc": "plc", "pc": "pc", "opc": "opc", "sarl": "sarl", "sas": "sas", "sasu": "sasu", "sa": "sa",
    "sci": "sci", "eurl": "eurl", "snc": "snc", "selarl": "selarl", "cie": "cie", "compagnie": "cie",
}
LEGAL_FORMS = sorted(set(LEGAL.values()))
# Words of names that say nothing.
NAME_FILLER = ["the", "and", "of", "india"]
# Words of addresses and their short forms.
ADDRESS = {
    "street": "st", "str": "st", "saint": "st", "road": "rd", "avenue": "ave", "av": "ave", "drive": "dr",
    "court": "ct", "place": "pl", "boulevard": "blvd", "bd": "blvd", "boul": "blvd", "lane": "ln",
    "highway": "hwy", "parkway": "pkwy", "circle": "cir", "square": "sq", "terrace": "ter", "trail": "trl",
    "suite": "ste", "apartment": "apt", "floor": "fl", "flr": "fl", "building": "bldg", "batiment": "bldg",
    "bat": "bldg", "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw",
    "southeast": "se", "southwest": "sw", "near": "nr", "opposite": "opp", "sector": "sec", "district": "dist",
    "r": "rue", "all": "allee", "chemin": "ch", "impasse": "imp", "route": "rte", "faubourg": "fbg",
    "residence": "res",
}
ADDRESS_DROP = ["no", "number", "num"]
# Names of states and regions and their codes.
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co",
    "connecticut": "ct", "delaware": "de", "district of columbia": "dc", "florida": "fl", "georgia": "ga",
    "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks",
    "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi",
    "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv",
    "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc",
    "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa",
    "rhode island": "ri", "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx",
    "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa", "west virginia": "wv",
    "wisconsin": "wi", "wyoming": "wy", "maharashtra": "mh", "delhi": "dl", "uttar pradesh": "up",
    "karnataka": "ka", "tamil nadu": "tn", "gujarat": "gj", "west bengal": "wb", "telangana": "tg",
    "haryana": "hr", "rajasthan": "rj", "kerala": "kl", "bihar": "br", "madhya pradesh": "mp",
    "andhra pradesh": "ap", "punjab": "pb", "orissa": "od", "odisha": "od", "hauts de france": "hdf",
    "nord": "hdf", "pas de calais": "hdf", "nouvelle aquitaine": "naq", "gironde": "naq",
    "pays de la loire": "pdl", "loire atlantique": "pdl",
}
# Patterns, in the syntax that Java, RE2 and Python share.
DOMAIN = r"\b([a-z0-9][a-z0-9-]*)\s*\.\s*(?:co\s*\.\s*in|com|net|org|in|co|fr|biz|info|us)\b"
ORDINAL = r"\b(\d+)(?:st|nd|rd|th)\b"
NUMERO = r"\b[nN]\s*[°º]\s*"
NUMBER_PREFIX = r"^(?:ndeg|num|no|n)(\d)"
LEADING_ZEROS = r"^0+(\d)"
# Bits of the retrieval views.
VIEW_BITS = {"full": 1, "name": 2, "addr": 4, "key": 8, "tfull": 16, "tname": 32, "taddr": 64, "hkey": 128}
# Word statistics of look-alike names.
FILLER_RATIO, FILLER_DOCS, VOCABULARY_SHARE, LRATIO_LEAST, LRATIO_MOST = 1.15, 20, 2.3e-6, -1.5, 1.1
STATE_CODES = sorted(set(STATES.values()) - {"la"})
