"""Carriers, airports, number-range rules, exact routes, region.

Everything here is data that results depend on. ``sources.dims`` turns these
lists into DataFrames; nothing else in the library holds literal tables.
"""

# --- region of interest ------------------------------------------------------

REGION_BOX = {"lat_min": 6.0, "lat_max": 37.0, "lon_min": 68.0, "lon_max": 98.0}
STREAM_REGION_BOX = {"lat_min": 8.0, "lat_max": 37.0, "lon_min": 68.0, "lon_max": 98.0}

# ICAO airport codes of the region start with this letter.
REGION_AIRPORT_LETTER = "V"

# Call-sign prefixes of the region's carriers (SG is listed twice at the origin).
REGION_PREFIXES = [
    "AIC", "AI", "IGO", "6E", "SEJ", "SG", "VTI", "UK", "GAL", "G8",
    "JAI", "9W", "LLR", "AXB", "IX", "ALW", "I5", "AAY", "QP",
]

# --- carriers ------------------------------------------------------------------

# ICAO prefix, name, IATA code
AIRLINES = [
    ("IGO", "IndiGo", "6E"),
    ("AIC", "Air India", "AI"),
    ("VTI", "Vistara", "UK"),
    ("SEJ", "SpiceJet", "SG"),
    ("AKJ", "Akasa Air", "QP"),
    ("AXB", "Air India Express", "IX"),
    ("JAI", "Air India Express", "IX"),
    ("ALK", "Alliance Air", "9I"),
    ("SAG", "Star Air", "S5"),
    ("FLY", "Fly91", "91"),
]

# Prefixes that the live enrichment and the hybrid enrichment recognise.
LIVE_PREFIXES = ["IGO", "AIC", "VTI", "SEJ", "AKJ", "AXB"]

# Carriers of published schedules: IATA code, name, ICAO prefix.
SCHEDULE_CARRIERS = [
    ("6E", "IndiGo", "IGO"),
    ("AI", "Air India", "AIC"),
    ("IX", "Air India Express", "IAD"),
    ("SG", "SpiceJet", "SEJ"),
    ("UK", "Vistara", "VTI"),
    ("QP", "Akasa Air", "AKJ"),
    ("G8", "Go First", "GOW"),
    ("9I", "Alliance Air", "LLR"),
]
UNKNOWN_CARRIER = ("XX", "Unknown", "UNK")

# --- airports ------------------------------------------------------------------

# code, name, city, latitude, longitude
AIRPORTS = [
    ("DEL", "Indira Gandhi International", "Delhi", 28.5562, 77.1000),
    ("BOM", "Chhatrapati Shivaji Maharaj", "Mumbai", 19.0896, 72.8656),
    ("BLR", "Kempegowda International", "Bangalore", 13.1986, 77.7066),
    ("MAA", "Chennai International", "Chennai", 12.9941, 80.1709),
    ("CCU", "Netaji Subhas Chandra Bose", "Kolkata", 22.6547, 88.4467),
    ("HYD", "Rajiv Gandhi International", "Hyderabad", 17.2403, 78.4294),
    ("COK", "Cochin International", "Kochi", 10.1520, 76.4019),
    ("GOI", "Goa International", "Goa", 15.3808, 73.8314),
    ("AMD", "Sardar Vallabhbhai Patel", "Ahmedabad", 23.0772, 72.6347),
    ("PNQ", "Pune Airport", "Pune", 18.5822, 73.9197),
    ("JAI", "Jaipur International", "Jaipur", 26.8242, 75.8122),
    ("LKO", "Chaudhary Charan Singh", "Lucknow", 26.7606, 80.8893),
    ("GAU", "Lokpriya Gopinath Bordoloi", "Guwahati", 26.1061, 91.5859),
    ("TRV", "Trivandrum International", "Thiruvananthapuram", 8.4821, 76.9200),
    ("IXC", "Chandigarh International", "Chandigarh", 30.6735, 76.7885),
    ("PAT", "Jay Prakash Narayan", "Patna", 25.5913, 85.0880),
    ("VNS", "Lal Bahadur Shastri", "Varanasi", 25.4524, 82.8593),
    ("IXR", "Birsa Munda Airport", "Ranchi", 23.3143, 85.3217),
    ("BBI", "Biju Patnaik International", "Bhubaneswar", 20.2444, 85.8178),
    ("SXR", "Sheikh ul-Alam International", "Srinagar", 33.9871, 74.7742),
    ("IXB", "Bagdogra Airport", "Bagdogra", 26.6812, 88.3286),
    ("CJB", "Coimbatore International", "Coimbatore", 11.0300, 77.0434),
    ("IXM", "Madurai Airport", "Madurai", 9.8345, 78.0934),
    ("NAG", "Dr. Babasaheb Ambedkar", "Nagpur", 21.0922, 79.0472),
    ("IDR", "Devi Ahilya Bai Holkar", "Indore", 22.7218, 75.8011),
    ("VTZ", "Visakhapatnam Airport", "Visakhapatnam", 17.7212, 83.2245),
    ("RPR", "Swami Vivekananda Airport", "Raipur", 21.1804, 81.7388),
    ("BDQ", "Vadodara Airport", "Vadodara", 22.3362, 73.2266),
    ("RAJ", "Rajkot Airport", "Rajkot", 22.3092, 70.7795),
    ("UDR", "Maharana Pratap Airport", "Udaipur", 24.6177, 73.8961),
]

# Airports known to the live enrichment.
LIVE_AIRPORT_CODES = ["DEL", "BOM", "BLR", "MAA", "CCU", "HYD", "COK", "GOI", "AMD", "PNQ"]

# Airports known to the hybrid enrichment; two have slightly other coordinates there.
HYBRID_AIRPORT_CODES = LIVE_AIRPORT_CODES + ["JAI", "IXC", "GAU", "IXB"]
HYBRID_COORDINATES = {"IXC": (30.6735, 76.7884), "IXB": (26.6815, 88.3286)}

# --- routes --------------------------------------------------------------------

# airline prefix, lowest and highest flight number, origin, destination.
# Order matters: where ranges overlap, the first rule wins.
NUMBER_RANGE_RULES = [
    ("IGO", 100, 199, "DEL", "BOM"), ("IGO", 200, 299, "DEL", "BLR"),
    ("IGO", 300, 399, "DEL", "CCU"), ("IGO", 400, 499, "BOM", "BLR"),
    ("IGO", 500, 599, "BOM", "DEL"), ("IGO", 600, 699, "BLR", "DEL"),
    ("IGO", 700, 799, "DEL", "MAA"), ("IGO", 800, 899, "BOM", "CCU"),
    ("IGO", 900, 999, "DEL", "HYD"), ("IGO", 1000, 1099, "BLR", "BOM"),
    ("IGO", 1100, 1199, "HYD", "DEL"), ("IGO", 1200, 1299, "MAA", "DEL"),
    ("IGO", 1300, 1399, "CCU", "DEL"), ("IGO", 1400, 1499, "DEL", "COK"),
    ("IGO", 1500, 1599, "BOM", "HYD"), ("IGO", 2000, 2999, "DEL", "GOI"),
    ("IGO", 5000, 5999, "BOM", "MAA"), ("IGO", 6000, 6999, "BLR", "CCU"),
    ("AIC", 100, 199, "DEL", "BOM"), ("AIC", 200, 299, "DEL", "BLR"),
    ("AIC", 300, 399, "DEL", "MAA"), ("AIC", 400, 499, "DEL", "CCU"),
    ("AIC", 500, 599, "BOM", "DEL"), ("AIC", 600, 699, "BOM", "BLR"),
    ("AIC", 800, 899, "DEL", "HYD"), ("AIC", 900, 999, "BLR", "DEL"),
    ("VTI", 800, 899, "DEL", "BOM"), ("VTI", 810, 819, "DEL", "BLR"),
    ("VTI", 820, 829, "DEL", "HYD"), ("VTI", 830, 839, "DEL", "MAA"),
    ("VTI", 840, 849, "DEL", "CCU"), ("VTI", 900, 999, "BOM", "DEL"),
    ("SEJ", 100, 199, "DEL", "BOM"), ("SEJ", 200, 299, "DEL", "GOI"),
    ("SEJ", 300, 399, "DEL", "HYD"), ("SEJ", 400, 499, "BOM", "DEL"),
    ("SEJ", 500, 599, "BOM", "BLR"),
    ("AKJ", 100, 199, "BOM", "BLR"), ("AKJ", 200, 299, "DEL", "BOM"),
    ("AKJ", 300, 399, "BOM", "DEL"), ("AKJ", 400, 499, "BLR", "DEL"),
]

# call sign, origin, destination
EXACT_ROUTES = [
    ("IGO100", "DEL", "BOM"), ("IGO101", "DEL", "BOM"), ("IGO102", "BOM", "DEL"),
    ("IGO103", "BOM", "DEL"), ("IGO200", "DEL", "BLR"), ("IGO201", "DEL", "BLR"),
    ("IGO202", "BLR", "DEL"), ("IGO203", "BLR", "DEL"), ("IGO300", "DEL", "CCU"),
    ("IGO301", "DEL", "CCU"), ("IGO302", "CCU", "DEL"), ("IGO400", "BOM", "BLR"),
    ("IGO401", "BOM", "BLR"), ("IGO402", "BLR", "BOM"), ("IGO500", "BOM", "MAA"),
    ("IGO600", "BLR", "CCU"), ("IGO700", "DEL", "MAA"), ("IGO800", "BOM", "CCU"),
    ("IGO900", "DEL", "HYD"), ("IGO981", "DEL", "HYD"), ("IGO1064", "BLR", "BOM"),
    ("IGO2441", "GOI", "DEL"), ("IGO5058", "BOM", "MAA"), ("IGO5077", "BOM", "MAA"),
    ("IGO6014", "BLR", "CCU"), ("IGO6019", "BLR", "CCU"), ("IGO6169", "CCU", "BLR"),
    ("IGO6510", "BLR", "CCU"), ("IGO6559", "CCU", "BLR"), ("IGO7207", "MAA", "BLR"),
    ("IGO7266", "MAA", "HYD"),
    ("AIC100", "DEL", "BOM"), ("AIC101", "DEL", "BOM"), ("AIC102", "BOM", "DEL"),
    ("AIC118", "DEL", "BOM"), ("AIC173", "DEL", "BOM"), ("AIC200", "DEL", "BLR"),
    ("AIC300", "DEL", "MAA"), ("AIC400", "DEL", "CCU"), ("AIC500", "BOM", "DEL"),
    ("AIC600", "BOM", "BLR"), ("AIC800", "DEL", "HYD"), ("AIC2927", "BOM", "GOI"),
    ("AIC2952", "GOI", "BOM"),
    ("SEJ100", "DEL", "BOM"), ("SEJ200", "DEL", "GOI"), ("SEJ300", "DEL", "HYD"),
    ("SEJ334", "DEL", "HYD"), ("SEJ400", "BOM", "DEL"), ("SEJ500", "BOM", "BLR"),
    ("VTI800", "DEL", "BOM"), ("VTI810", "DEL", "BLR"), ("VTI820", "DEL", "HYD"),
    ("VTI830", "DEL", "MAA"), ("VTI840", "DEL", "CCU"), ("VTI900", "BOM", "DEL"),
    ("AKJ100", "BOM", "BLR"), ("AKJ200", "DEL", "BOM"), ("AKJ300", "BOM", "DEL"),
    ("AKJ400", "BLR", "DEL"),
    ("AXB1513", "BLR", "COK"),
]

# --- thresholds and limits -----------------------------------------------------

NEAREST_SITE_KM = 50.0           # default radius of a nearest-site lookup
GROUND_SITE_KM = 20.0            # on the ground or low: site within this radius
GROUND_ALTITUDE_M = 1000.0
CRUISE_SITES_KM = 500.0          # both ends of a cruising aircraft
CRUISE_ALTITUDE_M = 5000.0
CRUISE_SPEED_MS = 50.0
ENDPOINT_SITE_KM = 30.0          # first and last position of a track
HYBRID_GROUND_KM = 15.0
HYBRID_GROUND_ALTITUDE_M = 500.0
HYBRID_CRUISE_ALTITUDE_M = 1000.0

SECONDS_PER_POINT = 10           # nominal report interval of one data point
LOOKBACK_DAYS = 7
STATE_KEY = ["icao24", "callsign", "last_contact"]

# Words that make a log line worth keeping.
LOG_KEYWORDS = [
    "ERROR", "WARNING", "CRITICAL", "EXCEPTION", "FAILED", "TRACEBACK",
    "DURATION", "SUCCESS", "TASK INSTANCE", "MARKING TASK", "FATAL",
]
