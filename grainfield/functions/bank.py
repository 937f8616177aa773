"""Word lists, patterns, ranges and weights of the field rules, in their declared order."""

FIELDS = ("dealer_name", "model_name", "horse_power", "asset_cost")
WEIGHTS = {"dealer_name": 0.20, "model_name": 0.25, "horse_power": 0.20, "asset_cost": 0.25, "signature": 0.05, "stamp": 0.05}
BRANDS = (
    "MAHINDRA", "SWARAJ", "ESCORTS", "EICHER", "JOHN DEERE", "CASE", "NEW HOLLAND", "SONALIKA", "KUBOTA", "MASSEY FERGUSON",
    "ACE", "PREET", "CAPTAIN", "POWERTRAC", "VST", "FARMTRAC", "TAFE", "INDO FARM", "STANDARD", "SAME DEUTZ-FAHR", "DEUTZ",
)
RULE_BRANDS = BRANDS[:19]
HP_RANGE, COST_RANGE = (20, 120), (50000, 5000000)
RULE_HP_RANGE, RULE_COST_RANGE, COST_PER_HP = (10, 150), (50000, 10000000), (8000, 25000)
HP_RANGES = {"extracted": HP_RANGE, "valid": RULE_HP_RANGE, "evaluated": (10, 200)}
COST_RANGES = {"extracted": COST_RANGE, "valid": RULE_COST_RANGE, "evaluated": (100000, 5000000)}
MODEL_HP = {
    "275": 35, "475": 42, "575": 50, "595": 50, "605": 51, "265": 31, "475 DI": 45, "585": 48, "595 DI": 55, "735": 40, "744": 48,
    "855": 55, "963": 63, "DI": 50, "XP": 55, "XT": 60, "MX": 65, "3630": 55,
}
MODEL_HP_RANGES = {
    "265": (28, 35), "275": (32, 38), "475": (40, 48), "485": (43, 51), "575": (47, 55), "585": (48, 56), "595": (50, 58), "605": (53, 63),
    "275 DI": (32, 38), "475 DI": (42, 50), "575 DI": (48, 56), "595 DI": (52, 62), "735": (38, 45), "744": (45, 52), "855": (52, 60), "963": (60, 68),
    "3600": (48, 56), "4710": (52, 60), "5620": (60, 68), "DI": (40, 60), "XP": (48, 62), "XT": (53, 68), "MX": (58, 72), "GT": (65, 78), "PRO": (55, 70),
}
BUSINESS_SUFFIXES = (
    "PVT LTD", "PRIVATE LIMITED", "LTD", "LIMITED", "CORPORATION", "CORP", "INC", "ENTERPRISES", "TRADERS", "MOTORS", "TRACTORS", "INDUSTRIES",
    "SALES", "SERVICES", "CO", "AND CO", "& CO", "DEALERSHIP", "AGENCY", "DISTRIBUTOR", "AUTOMOBILES",
)
RULE_SUFFIXES = (
    "tractors", "motors", "agency", "enterprises", "pvt", "ltd", "limited", "company", "corp", "inc", "dealer", "distributor", "trading", "sales",
    "services", "automotive", "machinery",
)
REJECT_TERMS = ("QUOTATION", "INVOICE", "PROFORMA", "DATE", "ADDRESS", "PHONE", "EMAIL", "MOBILE", "GST", "PAN", "BILL", "TAX", "CUSTOMER", "BUYER", "PURCHASER")
SECTION_KEYWORDS = {
    "dealer": ("dealer", "seller", "vendor", "supplier", "authorized", "distributor"),
    "model": ("model", "tractor", "variant", "type", "specification", "vehicle"),
    "specs": ("specification", "specs", "technical", "engine", "power", "capacity"),
    "financial": ("cost", "price", "amount", "total", "payment", "invoice", "payable"),
}
BLOCK_CURRENCY = ("₹", "Rs", "INR", "$")
CURRENCY = ("₹", "Rs", "Rs.", "INR", "रु", "रु.", "रुपए", "રૂ", "રૂ.", "રૂપિયા", "$", "USD", "€", "EUR", "£", "GBP", "¥", "JPY", "र", "रू")
KEYWORDS = {
    "dealer": ("dealer", "seller", "vendor", "supplier", "distributor", "authorized", "डीलर", "विक्रेता", "वेंडर", "ડીલર", "વેચનાર", "વિતરક"),
    "model": ("model", "type", "variant", "version", "tractor", "मॉडल", "प्रकार", "किस्म", "મોડેલ", "પ્રકાર", "વિવિધતા"),
    "hp": ("horse power", "hp", "h.p.", "h.p", "power", "bhp", "हॉर्स पावर", "एचपी", "शक्ति", "હોર્સ પાવર", "શક્તિ"),
    "cost": ("cost", "price", "amount", "total", "value", "asset cost", "ex-showroom", "लागत", "मूल्य", "राशि", "कुल", "ખર્ચ", "કિંમત", "રકમ", "કુલ"),
    "invoice": ("invoice", "bill", "quotation", "quote", "estimate", "proforma", "बीजक", "बिल", "કોટેશન", "બિલ"),
}
OCR_CORRECTIONS = (("O", "0"), ("l", "1"), ("I", "1"), ("S", "5"), ("Z", "2"))
DEALER_PATTERNS = (
    r"""(?i)(?:dealer(?:\s+name)?|seller|vendor|supplier|authorized\s+dealer)[\s:]+([A-Za-z0-9\s&.,()'"-]{3,80})""",
    r"""(?i)(?:M/s|M\.s\.|Messrs\.?)[\s:]*([A-Za-z0-9\s&.,()'"-]{3,80})""",
    r"""(?i)(?:name\s+of\s+dealer|dealer\s+name)[\s:]+([A-Za-z0-9\s&.,()'"-]{3,80})""",
    r"""(?i)\b([A-Z][A-Za-z0-9\s&.,()'"-]{2,60}(?:PVT\.?\s*LTD\.?|PRIVATE\s+LIMITED|LTD\.?|LIMITED|ENTERPRISES|TRADERS|MOTORS|TRACTORS|AUTOMOBILES))\b""",
    r"""(?i)\b([A-Z][A-Za-z0-9\s&.,()'"-]{3,50})\s*(?:AT|POST|VILLAGE|TALUKA|DIST|ADDRESS)""",
    r"""(?i)(?:QUOTATION|INVOICE|PROFORMA)\s+(?:FROM|BY)[\s:]+([A-Za-z0-9\s&.,()'"-]{3,80})""",
    r"(?i)(?:डीलर|ડીલર|विक्रेता)[\s:]+([^\n]{3,60})",
)
#: For each pattern, words of which a text must hold one for a match: those of dealers and models in upper case, those of power and cost in lower case.
DEALER_WORDS = (
    ("DEALER", "SELLER", "VENDOR", "SUPPLIER"), ("M/S", "M.S.", "MESSRS"), ("DEALER",), ("LTD", "LIMITED", "ENTERPRISES", "TRADERS", "MOTORS", "TRACTORS", "AUTOMOBILES"),
    ("AT", "POST", "VILLAGE", "TALUKA", "DIST", "ADDRESS"), ("QUOTATION", "INVOICE", "PROFORMA"), ("डीलर", "ડીલર", "विक्रेता"),
)
MODEL_WORDS = (("MODEL",), (), ("VARIANT", "TYPE"), ("मॉडल", "મોડેલ"))
HP_WORDS = (("power", "hp", "h.p."), ("hp", "h.p."), ("kw",), ("पावर", "શક્તિ"), ("hp",))
COST_WORDS = (("total", "cost", "price", "showroom"), ("₹",), ("rs", "inr"), ("lakh", "lac", "cr"), ("payable",), ("amount",))
MODEL_PATTERNS = (
    r"(?i)(?:model(?:\s+name)?|tractor\s+model|model\s+no\.?)[\s:]+([A-Za-z0-9\s\-/]{2,40})",
    r"(?i)\b((?:[A-Z]+\s+)?[2-9]\d{2,3}\s*(?:DI|XP|XT|MX|TA|FE|GT|PRO|PLUS|POWER)?)\b",
    r"(?i)(?:variant|type)[\s:]+([A-Za-z0-9\s\-/]{2,40})",
    r"(?i)(?:मॉडल|મોડેલ)[\s:]+([^\n]{2,40})",
)
BRAND_MODEL_PATTERN = r"(?i)\b(" + "|".join(BRANDS) + r")\s+([A-Z0-9\s\-/]{2,20})\b"
BRAND_CONTEXT_PATTERN = r"(?i)^[:\s]*([A-Z0-9\s\-/]{2,20})"
HP_PATTERNS = (
    r"(?i)(?:horse\s*power|hp|h\.p\.|bhp|power)[\s:]*(\d+(?:\.\d+)?)",
    r"(?i)(\d+(?:\.\d+)?)\s*(?:hp|bhp|h\.p\.)",
    r"(?i)(\d+(?:\.\d+)?)\s*kw",
    r"(?i)(?:हॉर्स\s*पावर|શક્તિ)[\s:]*(\d+(?:\.\d+)?)",
    r"(?i)(?:engine|capacity)[\s:]*(\d+)\s*hp",
)
COST_PATTERNS = (
    r"(?i)(?:total\s*(?:cost|price|amount)|asset\s*cost|price|ex-?showroom|grand\s+total)[\s:]*[₹$Rs.]*\s*([0-9,]+(?:\.[0-9]+)?)",
    r"(?i)[₹]\s*([0-9,]+(?:\.[0-9]+)?)",
    r"(?i)(?:Rs\.?|INR)[\s]*([0-9,]+(?:\.[0-9]+)?)",
    r"(?i)([0-9,]+(?:\.[0-9]+)?)\s*(lakh|lac|crore|cr)",
    r"(?i)(?:payable|amount\s+payable)[\s:]*[₹$Rs.]*\s*([0-9,]+)",
    r"(?i)(?:net\s+amount|final\s+amount)[\s:]*[₹$Rs.]*\s*([0-9,]+)",
)
MULTIPLIER_PATTERN_NO = 3
CLEAN_STEPS = (
    (r"(?i)^(?:M/s|M\.s\.|Messrs\.?|Ms\.?|Sri|Shri)\s*", ""),
    (r"[,.:;]+$", ""),
    (r"(?i)\s*(?:Pvt\.?\s*Ltd\.?|Private\s+Limited)\s*$", " Pvt Ltd"),
    (r"(?i)\s*(?:Ltd\.?|Limited)\s*$", " Ltd"),
)
SCALAR_HP_PATTERNS = (
    r"(?i)(\d+(?:\.\d+)?)\s*(?:HP|H\.P\.?|Horse\s*Power|BHP)",
    r"(?i)(?:HP|H\.P\.?|Horse\s*Power)[\s:]*(\d+(?:\.\d+)?)",
    r"(?i)(\d+(?:\.\d+)?)\s*(?:हॉर्स\s*पावर|એચપી|હોર્સ\s*પાવર)",
    r"(?i)(\d+(?:\.\d+)?)\s*kw",
)
SCALAR_MODEL_PATTERNS = (
    (r"(?i)\b([2-9]\d{2,3}\s*(?:DI|XP|XT|MX|TA|FE|GT|R|S|E|PRO|PLUS)?)\b", 1),
    (r"(?i)(?:model|type)[\s:]+([A-Za-z0-9\s\-/]{2,30})", 1),
    (r"(?i)\b(MAHINDRA|SWARAJ|JOHN\s+DEERE)\s+([A-Za-z0-9\s\-]{2,20})", 2),
)
PII_STEPS = (
    (r"\b[\w.%+-]+@[\w.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL]"),
    (r"(?:\+91[\-\s]?)?[6789]\d{9}\b", "[PHONE]"),
    (r"\b[A-Z]{5}\d{4}[A-Z]\b", "[PAN]"),
    (r"\b\d{2}[A-Z]{5}\d{4}[A-Z]\d[Z]\d\b", "[GST]"),
    (r"\b\d{4}\s?\d{4}\s?\d{4}\b", "[AADHAR]"),
    (r"\b\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}\b", "[DATE]"),
    (r"\b\d{4}[/\-]\d{1,2}[/\-]\d{1,2}\b", "[DATE]"),
)
NOISE = "|_~`^"
SPECIAL = r"[^\p{L}\p{N}_\s.,;:()\-/₹]"
INDIAN_NUMBER = r"\d+(?:,\d{2})*(?:,\d{3})?(?:\.\d+)?"
PLAIN_NUMBER = r"\d+(?:,\d+)*(?:\.\d+)?"
MULTIPLIER = r"(?i)(\d+(?:\.\d+)?)\s*(lakh|lac|lakhs|crore|cr|crores)"
RULE_MODEL = r"(?i)\b([2-9]\d{2,3}\s*(?:[A-Z]{1,3})?)\b"
RULE_SPECIAL = r"[^a-zA-Z0-9\s&.,()-]"
VLM_PATTERNS = {
    "dealer_name": (r"(?i)dealer[:\s]+([^\n,]+)", r"(?i)डीलर[:\s]+([^\n,]+)", r"(?i)ડીલર[:\s]+([^\n,]+)"),
    "model_name": (r"(?i)model[:\s]+([A-Za-z0-9\s\-]+)", r"(?i)मॉडल[:\s]+([^\n,]+)", r"(?i)મોડેલ[:\s]+([^\n,]+)"),
    "horse_power": (r"(?i)horse[-\s]*power[:\s]*(\d+(?:\.\d+)?)", r"(?i)HP[:\s]*(\d+(?:\.\d+)?)", r"(?i)हॉर्स पावर[:\s]*(\d+(?:\.\d+)?)"),
    "asset_cost": (r"(?i)cost[:\s]*[₹$Rs]?\s*(\d[\d,]*\.?\d*)", r"(?i)लागत[:\s]*[₹रु]?\s*(\d[\d,]*)", r"(?i)ખર્ચ[:\s]*[₹રૂ]?\s*(\d[\d,]*)"),
}
DETECTION_CONFIDENCE = {"signature": 0.4, "stamp": 0.5}
DETECTION_AREA = (0.00005, 0.6)
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "tiff", "tif", "pdf")
DETECTOR_EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "tiff", "pdf")
PRICE_PER_HOUR = {"gpu": 0.10, "cpu": 0.01}
LANGUAGE_ALIASES = {"english": ("english", "en", "eng"), "hindi": ("hindi", "hi", "hin"), "gujarati": ("gujarati", "gu", "guj")}
ASSESSMENTS = ("EXCELLENT - All targets achieved", "GOOD - Most targets achieved", "FAIR - Some targets achieved", "NEEDS IMPROVEMENT - Few targets achieved")
# The first four have conditions, the others are always given.
ADVICE = (
    "Improve OCR accuracy for low-quality scans using better preprocessing",
    "Optimize VLM usage - only use when confidence is very low to reduce processing time",
    "Add retry logic for failed OCR attempts with different preprocessing parameters",
    "Reduce VLM dependency by improving rule-based extraction patterns",
    "Implement active learning to improve model with difficult cases",
    "Add more language-specific patterns for Hindi and Gujarati documents",
    "Optimize YOLO model with more signature/stamp training data",
    "Implement caching for frequently seen document templates",
)
VLM_CONTEXT = 300
VLM_PROMPTS = {
    "english": """Extract invoice fields as JSON:
{context}

Required: dealer_name, model_name, horse_power (number), asset_cost (number), 
signature_present (bool), stamp_present (bool)

Rules:
- Extract exact values only
- Use null for missing fields
- Numbers only for numeric fields
- Return valid JSON only

Format:
{"dealer_name": null, "model_name": null, "horse_power": null, 
"asset_cost": null, "signature_present": false, "stamp_present": false}""",
    "hindi": """JSON प्रारूप में इनवॉइस फ़ील्ड निकालें:
{context}

आवश्यक: dealer_name, model_name, horse_power (संख्या), asset_cost (संख्या),
signature_present (bool), stamp_present (bool)

JSON लौटाएं।""",
    "gujarati": """JSON ફોર્મેટમાં ઇનવોઇસ ફીલ્ડ્સ કાઢો:
{context}

જરૂરી: dealer_name, model_name, horse_power (નંબર), asset_cost (નંબર),
signature_present (bool), stamp_present (bool)

JSON પરત કરો।""",
}
