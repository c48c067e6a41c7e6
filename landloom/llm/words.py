"""Word tables for people's names and postal addresses, and edit distance."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

# Given names and the short and pet forms in common use for each.
GIVEN = {
    "ABRAHAM": "ABE", "ADRIAN": "", "ALBERT": "AL BERT BERTIE", "ALEJANDRO": "ALEX ALE", "ALEXANDER": "ALEX ALEC AL SANDY", "ALEXANDRA": "ALEX SANDRA LEXI SANDY",
    "ALFRED": "AL FRED ALF", "ALICE": "ALI", "AMANDA": "MANDY", "ANDREA": "ANDI", "ANDRÉ": "ANDY", "ANDREW": "ANDY DREW", "ANGELA": "ANGIE", "ANNA": "ANN ANNIE", "ANTHONY": "TONY ANT", "ANTONIO": "TONY TOÑO",
    "ARTHUR": "ART ARTIE", "BARBARA": "BARB BABS", "BEATRICE": "BEA TRIXIE", "BENJAMIN": "BEN BENJ BENNY", "BRIAN": "", "CARLOS": "", "CAROLINE": "CAROL CARRIE", "CATHERINE": "CATHY KATE CAT KIT",
    "CHARLES": "CHARLIE CHUCK CHAS CHARLEY", "CHRISTINA": "CHRIS TINA CHRISTY", "CHRISTOPHER": "CHRIS KIT TOPHER", "CLARENCE": "", "CONSUELO": "CHELO", "CORNELIUS": "NEIL CORNIE", "CYNTHIA": "CINDY",
    "DANIEL": "DAN DANNY", "DAVID": "DAVE DAVEY", "DEBORAH": "DEBBIE DEB DEBRA", "DENNIS": "DENNY", "DOLORES": "LOLA", "DONALD": "DON DONNIE", "DONOVAN": "DON DONNIE", "DOROTHY": "DOT DOTTIE DOLLY", "DOUGLAS": "DOUG",
    "EDUARDO": "LALO", "EDWARD": "ED EDDIE EDW NED TED TEDDY", "EDWIN": "ED EDDIE", "ELEANOR": "ELLIE NELL NORA", "ELIZABETH": "BETTY LIZ BETH LIZZIE ELIZ ELIZA BETSY", "EMILY": "EM", "ENRIQUE": "KIKO QUIQUE", "ERNEST": "ERNIE",
    "EUGENE": "GENE", "EVELYN": "EVE", "FERNANDO": "NANDO", "FLORENCE": "FLO", "FRANCES": "FRAN FRANNIE", "FRANCIS": "FRANK", "FRANCISCO": "PACO PANCHO FRANK", "FRANKLIN": "FRANK", "FREDERICK": "FRED FREDDY FREDK",
    "GABRIEL": "GABE", "GEORGE": "GEO", "GERALD": "JERRY GERRY", "GERALDINE": "GERRI", "GREGORY": "GREG", "GUADALUPE": "LUPE", "HAROLD": "HAL HARRY", "HELEN": "NELL", "HENRY": "HANK HARRY HAL",
    "HERBERT": "HERB BERT", "HOWARD": "HOWIE", "HUMBERTO": "BETO", "IGNACIO": "NACHO", "INÉS": "", "ISABEL": "BELLA CHABELA", "ISAAC": "IKE", "JACOB": "JAKE", "JACQUELINE": "JACKIE", "JAMES": "JIM JIMMY JAS JAMIE",
    "JANET": "JAN", "JEFFREY": "JEFF", "JENNIFER": "JEN JENNY", "JESSICA": "JESS JESSIE", "JESÚS": "CHUY", "JOHN": "JACK JOHNNY JNO", "JONATHAN": "JON", "JOSEPH": "JOE JOS JOEY", "JOSÉ": "PEPE", "JOSÉ LUIS": "PEPE",
    "JOSÉ MARÍA": "CHEMA", "JOSHUA": "JOSH", "JUAN": "", "JUAN CARLOS": "JUANCA", "JUDITH": "JUDY", "JULIAN": "JULES", "KATHERINE": "KATE KATHY KATIE KAY KATHRYN", "KENNETH": "KEN KENNY", "KIMBERLY": "KIM",
    "LAWRENCE": "LARRY LAWR", "LEONARD": "LEN LENNY LEO", "LEWIS": "LEW", "LILLIAN": "LIL LILY", "LINDA": "", "LOUIS": "LOU LOUIE", "LUCILLE": "LUCY", "LUIS": "", "MANUEL": "MANNY MANOLO", "MARGARET": "PEGGY MAGGIE MEG MARGE", "MARÍA": "MARI",
    "MARTHA": "MATTIE MARTY", "MARTIN": "MARTY", "MARY": "MOLLY POLLY", "MARY ANN": "MARYANN", "MATTHEW": "MATT", "MAXIMILIAN": "MAX", "MERCEDES": "MECHE", "MICHAEL": "MIKE MICK MICKEY", "MIGUEL": "", "MILDRED": "MILLIE", "NANCY": "NAN", "NATHANIEL": "NATE NAT NATHAN",
    "NICHOLAS": "NICK", "OLIVER": "OLLIE", "OPHELIA": "", "PAMELA": "PAM", "PATRICIA": "PAT PATTY TRISH TRICIA", "PATRICK": "PAT PADDY", "PAUL": "", "PETER": "PETE", "PHILIP": "PHIL", "RACHEL": "RAE", "RAFAEL": "RAFA", "RANDOLPH": "RANDY", "RAYMOND": "RAY",
    "REBECCA": "BECKY BECCA", "RICHARD": "DICK RICK RICH RICHIE", "ROBERT": "BOB ROB ROBT BOBBY BERT", "ROBERTO": "BETO", "ROGER": "", "RONALD": "RON RONNIE", "ROSALINDA": "LINDA ROSA", "RUTH": "", "SAMANTHA": "SAM", "SAMUEL": "SAM SAMMY SAML", "SANDRA": "SANDY",
    "SARAH": "SALLY SADIE", "SHIRLEY": "", "STEPHANIE": "STEPH", "STEPHEN": "STEVE STEVEN", "SUSAN": "SUE SUSIE", "SUSANNAH": "SUSIE SUE", "TERESA": "TERRY TERE", "TERRENCE": "TERRY", "THEODORE": "TED THEO TEDDY",
    "THOMAS": "TOM THOS TOMMY", "TIMOTHY": "TIM", "VALENTINA": "VAL", "VICTOR": "VIC", "VICTORIA": "VICKY TORI", "VINCENT": "VINCE", "VIRGINIA": "GINNY GINGER", "WALTER": "WALT WALLY", "WILLIAM": "BILL WILL WM BILLY LIAM", "ZACHARY": "ZACH ZACK",
}
#: Words that begin a surname of several words.
PARTICLES = frozenset("DE DEL LA LAS LOS VAN VON DER DEN DI DA DOS DU ST SAN MC MAC".split())
# Words for a kind of business and their abbreviations.
BUSINESS = {
    "ACQUISITIONS": "ACQ", "AGGREGATES": "AGG AGGR", "ASSOCIATES": "ASSOC ASSOCS", "BUILDERS": "BLDRS", "CAPITAL": "CAP", "CATTLE": "CTL",
    "COMPANY": "CO", "DEVELOPMENT": "DEV DEVEL DEVT", "ENERGY": "ENGY", "ENTERPRISES": "ENT ENTERPR ENTPR", "FAMILY": "FAM",
    "FARMS": "FARM", "GROUP": "GRP", "HOLDINGS": "HLDGS HOLDING", "HOMES": "HOME", "HOSPITALITY": "HOSP", "INVESTMENTS": "INVEST INVTS INV",
    "LAND": "", "LIVESTOCK": "LVSTK", "MANAGEMENT": "MGMT MGT", "MINERALS": "MIN MINS", "ORCHARDS": "ORCHARD", "PARTNERS": "PTNRS PRTNRS",
    "PROPERTIES": "PPTYS PROPS PROPERTY PROP", "RANCH": "RNCH", "REALTY": "RLTY", "RESOURCES": "RES RSRCS", "STORAGE": "STOR", "SUPPLY": "SUP",
    "TIMBER": "TBR", "TRUST": "TR", "VENTURES": "VENT", "WATER": "WTR",
}
# Legal forms.
LEGAL = {"LLC": "", "LP": "", "INC": "INCORPORATED", "CORP": "CORPORATION", "LTD": "LIMITED"}
# Generations and series numbers.
GENERATION = {"JR": "JUNIOR", "SR": "SENIOR"}
ROMAN = {"I": "1", "II": "2", "III": "3", "IV": "4", "V": "5", "VI": "6", "VII": "7", "VIII": "8", "IX": "9"}

# Street types, directions, states and their other writings.
STREET = {
    "AVE": "AVENUE AV AVEN", "BLVD": "BOULEVARD BLV BOUL", "CIR": "CIRCLE CIRC", "CT": "COURT CRT", "DR": "DRIVE DRV", "LN": "LANE",
    "LOOP": "LP", "PKWY": "PARKWAY PKY", "PL": "PLACE PLC", "RD": "ROAD", "ST": "STREET STR", "TRL": "TRAIL TR",
    "HWY": "HIGHWAY", "WAY": "WY", "TER": "TERRACE", "SQ": "SQUARE",
}
# Words of streets and cities and their abbreviations.
PLACE_WORD = {
    "BEND": "BND", "BLUFF": "BLF", "BRANCH": "BR", "BRIDGE": "BRG", "CANYON": "CYN", "CENTER": "CTR CENTRE CNTR", "CREEK": "CRK CK", "CROSSING": "XING CRSSNG", "ESTATES": "EST ESTS", "FALLS": "FLS", "FERRY": "FRY", "FOREST": "FRST",
    "FORK": "FRK", "FORT": "FT", "GARDENS": "GDNS", "GLEN": "GLN", "GROVE": "GRV", "HARBOR": "HBR", "HEIGHTS": "HTS HGTS", "HILL": "HL", "HILLS": "HLS", "HOLLOW": "HOLW", "ISLAND": "IS ISL", "JUNCTION": "JCT", "KNOLL": "KNL", "LAKE": "LK",
    "LANDING": "LNDG", "MEADOW": "MDW", "MEADOWS": "MDWS", "MILL": "ML", "MOUNT": "MT", "MOUNTAIN": "MTN", "ORCHARD": "ORCH", "POINT": "PT", "PORT": "PRT", "RANCH": "RNCH", "RIDGE": "RDG", "RIVER": "RIV", "SPRING": "SPG", "SPRINGS": "SPGS SPRGS", "STATION": "STA",
    "VALLEY": "VLY", "VIEW": "VW", "VILLAGE": "VLG", "VISTA": "VIS",
}
DIRECTION = {"N": "NORTH", "S": "SOUTH", "E": "EAST", "W": "WEST"}
FEATURE = "BEND BLUFF CANYON CREEK CROSSING GROVE HILL HOLLOW KNOLL LANDING MEADOW MILL OAKS ORCHARD PASTURE POINT RIDGE SPRINGS".split()
CITY_END = "CITY GROVE SPRINGS".split()
UNIT = "APT UNIT STE SUITE NO # RM FL BLDG LOT".split()
STATE = {
    "TX": "TEXAS TEX", "AR": "ARKANSAS ARK", "CA": "CALIFORNIA CALIF", "CO": "COLORADO COLO", "FL": "FLORIDA FLA", "LA": "LOUISIANA",
    "NM": "NEWMEXICO", "OK": "OKLAHOMA OKLA", "AZ": "ARIZONA ARIZ", "KS": "KANSAS", "NY": "NEWYORK", "GA": "GEORGIA", "IL": "ILLINOIS", "MO": "MISSOURI", "TN": "TENNESSEE TENN", "MS": "MISSISSIPPI MISS",
}


def plain(text: str) -> str:
    """Upper case without accents; compatibility forms and no-break spaces made ordinary."""
    if text.isascii():
        return text.upper()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()


def forms(table: dict[str, str]) -> dict[str, str]:
    """Every writing of every entry, without accents and spaces, to the entry's plain form."""
    return {form: full for form, full in ((f, plain(name)) for name, others in table.items() for f in _writings(name, others))}


def _writings(name: str, others: str) -> list[str]:
    return [plain(f).replace(" ", "") for f in (name, *others.split())]


def all_forms(table: dict[str, str]) -> dict[str, str]:
    """Every writing to all entries that it may stand for, in order, with a slash between."""
    out: dict[str, set[str]] = {}
    for name, others in table.items():
        for form in _writings(name, others):
            out.setdefault(form, set()).add(plain(name).replace(" ", ""))
    return {form: "/".join(sorted(full)) for form, full in out.items()}


GIVEN_FORMS = all_forms(GIVEN)
#: Given names of two words, joined.
COMPOUND_FORMS = {f: f for f in (plain(n).replace(" ", "") for n in GIVEN if " " in n)}
BUSINESS_FORM, LEGAL_FORM = forms(BUSINESS), forms(LEGAL)
GENERATION_FORM, STREET_FORM, DIRECTION_FORM, STATE_FORM, PLACE_FORM = forms(GENERATION), forms(STREET), forms(DIRECTION), forms(STATE), forms(PLACE_WORD)


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours (each place edited once), or most + 1 when larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


class Snap:
    """Nearest entry of a closed word list by edit distance; answers are kept.

    Of several entries equally near all meanings count, with a slash between.
    """

    def __init__(self, table: dict[str, str]) -> None:
        self.table = table
        self.long: dict[int, list[str]] = {}
        for w in table:
            if len(w) > 3:
                self.long.setdefault(len(w), []).append(w)
        self.near = lru_cache(200_000)(self._near)

    def _near(self, token: str) -> str | None:
        exact = self.table.get(token)
        if exact or len(token) < 4:
            return exact
        most = 1 if len(token) < 7 else 2
        best, found = most + 1, []
        for size in range(len(token) - most, len(token) + most + 1):
            for w in self.long.get(size, ()):
                if w[0] == token[0] or w[1] == token[0] or w[0] == token[1] or w[-1] == token[-1]:
                    limit = min(best, most, 1 if len(w) < 6 else 2)
                    d = distance(token, w, limit)
                    if d <= limit:
                        found = [*(found if d == best else ()), w]
                        best = d
        return "/".join(sorted({m for w in found for m in self.table[w].split("/")})) or None
