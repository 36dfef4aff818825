"""Names, patterns and texts that results depend on."""

# fixed values: columns of the curated flight table that the feature step reads
CURATED_COLUMNS = [
    "Year",
    "Quarter",
    "Month",
    "DayofMonth",
    "DayOfWeek",
    "FlightDate",
    "CRSDepTime",
    "CRSArrTime",
    "CRSElapsedTime",
    "Reporting_Airline",
    "Origin",
    "OriginState",
    "OriginWac",
    "Dest",
    "DestState",
    "DestWac",
    "Distance",
    "DistanceGroup",
    "DOT_ID_Reporting_Airline",
    "OriginAirportID",
    "DestAirportID",
    "ArrDel15",
    "ArrDelay",
    "Cancelled",
    "Diverted",
]

# fixed values: columns a flight needs to be kept
REQUIRED_VALUES = [
    "ArrDel15",
    "ArrDelay",
    "CRSDepTime",
    "CRSArrTime",
    "CRSElapsedTime",
    "Distance",
    "Reporting_Airline",
    "Origin",
    "Dest",
]

# fixed values: columns shown by the preview
PREVIEW_COLUMNS = ["Year", "Month", "Origin", "Dest", "DepDelay", "ArrDelay"]

# fixed values: model inputs
CATEGORICAL_COLUMNS = ["season", "dep_time_bucket", "carrier", "origin", "dest"]
NUMERIC_COLUMNS = [
    "year",
    "quarter",
    "month",
    "day_of_month",
    "day_of_week",
    "day_of_year",
    "week_of_year",
    "is_weekend",
    "sched_dep_minutes",
    "sched_arr_minutes",
    "sched_dep_hour",
    "sched_arr_hour",
    "origin_wac",
    "dest_wac",
    "scheduled_elapsed_time",
    "distance",
    "distance_group",
]
HISTORY_COLUMNS = ["origin_hist_delay_rate", "route_hist_delay_rate"]
LABEL = "label_delay_15"

# fixed values: last training year and validation year
TRAIN_UNTIL = 2022
VALID_UNTIL = 2023

# fixed values: file names of the public monthly archives
ARCHIVE_NAME = r"On_Time_Reporting_Carrier_On_Time_Performance_1987_present_(\d{4})_(\d{1,2})\.zip"
LISTED_NAME = (
    r"On_Time_Reporting_Carrier_On_Time_Performance(?:_1987_present|_\(1987_present\))_(\d{4})_(\d{1,2})\.zip"
)

# fixed values: airports as code, world area code, latitude, longitude, city
AIRPORTS = [
    ("ATL", 34, 33.6407, -84.4277, "Atlanta, GA"),
    ("BOS", 13, 42.3656, -71.0096, "Boston, MA"),
    ("CLT", 36, 35.2144, -80.9473, "Charlotte, NC"),
    ("DCA", 38, 38.8512, -77.0402, "Washington, DC"),
    ("DEN", 82, 39.8561, -104.6737, "Denver, CO"),
    ("DFW", 74, 32.8998, -97.0403, "Dallas/Fort Worth, TX"),
    ("DTW", 43, 42.2162, -83.3554, "Detroit, MI"),
    ("EWR", 21, 40.6895, -74.1745, "Newark, NJ"),
    ("IAD", 38, 38.9531, -77.4565, "Washington Dulles, VA"),
    ("IAH", 74, 29.9902, -95.3368, "Houston, TX"),
    ("JFK", 22, 40.6413, -73.7781, "New York, NY"),
    ("LAS", 85, 36.0840, -115.1537, "Las Vegas, NV"),
    ("LAX", 91, 33.9416, -118.4085, "Los Angeles, CA"),
    ("MCO", 33, 28.4312, -81.3081, "Orlando, FL"),
    ("MIA", 33, 25.7959, -80.2870, "Miami, FL"),
    ("MSP", 63, 44.8848, -93.2223, "Minneapolis, MN"),
    ("ORD", 41, 41.9742, -87.9073, "Chicago, IL"),
    ("PDX", 92, 45.5898, -122.5951, "Portland, OR"),
    ("PHL", 23, 39.8744, -75.2424, "Philadelphia, PA"),
    ("PHX", 81, 33.4342, -112.0116, "Phoenix, AZ"),
    ("SAN", 91, 32.7338, -117.1933, "San Diego, CA"),
    ("SAT", 74, 29.5337, -98.4698, "San Antonio, TX"),
    ("SBN", 42, 41.7087, -86.3173, "South Bend, IN"),
    ("SEA", 93, 47.4502, -122.3088, "Seattle, WA"),
    ("SFO", 91, 37.6213, -122.3790, "San Francisco, CA"),
    ("SJC", 91, 37.3639, -121.9289, "San Jose, CA"),
]

# fixed values: risk bands by least probability
HIGH_RISK = 0.65
MEDIUM_RISK = 0.35

# fixed values: long-haul distance
LONG_HAUL_MILES = 1500

# fixed values: reason texts
REASON_LATE_IN_DAY = "The flight departs later in the day, when delay propagation is usually stronger."
REASON_LONG_HAUL = "This is a long-haul route, which usually has more operational exposure."
REASON_SEASON = "The travel season is historically more disruption-prone."
REASON_WEEKEND = "Weekend schedules often behave differently from weekday business traffic."
REASON_NONE = "The route and schedule look relatively stable in the baseline feature set."

# fixed values: answer texts
TEXT_EXPLAIN = "Estimated delay>=15m probability is %s, which falls in the %s risk band."
TEXT_PREDICT = "Estimated delay>=15m probability is %s. The current flight is in the %s risk band."
TEXT_ROUTE = (
    "Route %s to %s is about %.1f miles. Origin WAC is %d and destination WAC is %d."
)
TEXT_HELP = (
    "I can predict delay risk, explain the current prediction, or report route metadata. "
    "Try: 'predict this flight', 'explain this prediction', or 'what is the route distance?'"
)
TEXT_NEED_ROUTE = "Provide a flight context or mention both three-letter airport codes."
TEXT_NEED_FLIGHT_TO_EXPLAIN = "Explain requests need the current flight context from the form."
TEXT_NEED_FLIGHT_TO_PREDICT = "Prediction requests need the current flight context from the form."

# fixed values: words that decide which tool answers a message, in order of precedence
INTENT_WORDS = [
    ("get_route_info", ["route", "distance", "airport", "wac"]),
    ("explain_prediction", ["why", "explain", "reason"]),
    ("predict_delay", ["predict", "delay", "risk", "late"]),
]

# fixed values: supported classifiers and selection metrics
MODEL_NAMES = ["lr", "rf", "gbt"]
SELECTION_METRICS = [
    "valid_pr_auc",
    "valid_roc_auc",
    "valid_f1",
    "test_pr_auc",
    "test_roc_auc",
    "test_f1",
]
