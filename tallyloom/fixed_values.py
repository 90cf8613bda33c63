"""Code books, name lists and record shapes the jobs are defined with."""

from __future__ import annotations

from pyspark.sql import types as T

EVENT_TYPES = {
    0: "Announcement", 1: "Attempt", 2: "Corner", 3: "Foul", 4: "Yellow card",
    5: "Second yellow card", 6: "Red card", 7: "Substitution", 8: "Free kick won",
    9: "Offside", 10: "Hand ball", 11: "Penalty conceded",
}
SECOND_EVENT_TYPES = {
    12: "Key Pass", 13: "Failed through ball", 14: "Sending off", 15: "Own goal",
}
SIDES = {1: "Home", 2: "Away"}
SHOT_PLACES = {
    1: "Bit too high", 2: "Blocked", 3: "Bottom left corner", 4: "Bottom right corner",
    5: "Centre of the goal", 6: "High and wide", 7: "Hits the bar", 8: "Misses to the left",
    9: "Misses to the right", 10: "Too high", 11: "Top centre of the goal",
    12: "Top left corner", 13: "Top right corner",
}
SHOT_OUTCOMES = {1: "On target", 2: "Off target", 3: "Blocked", 4: "Hit the bar"}
LOCATIONS = {
    1: "Attacking half", 2: "Defensive half", 3: "Centre of the box", 4: "Left wing",
    5: "Right wing", 6: "Difficult angle and long range", 7: "Difficult angle on the left",
    8: "Difficult angle on the right", 9: "Left side of the box",
    10: "Left side of the six yard box", 11: "Right side of the box",
    12: "Right side of the six yard box", 13: "Very close range", 14: "Penalty spot",
    15: "Outside the box", 16: "Long range", 17: "More than 35 yards",
    18: "More than 40 yards", 19: "Not recorded",
}
BODY_PARTS = {1: "Right foot", 2: "Left foot", 3: "Head"}
ASSIST_METHODS = {0: "None", 1: "Pass", 2: "Cross", 3: "Headed pass", 4: "Through ball"}
SITUATIONS = {1: "Open play", 2: "Set piece", 3: "Corner", 4: "Free kick"}
COUNTRY_CODES = {
    "germany": "DEU", "france": "FRA", "england": "GBR", "spain": "ESP", "italy": "ITA",
}

MATCH_EVENT_BOOKS = {
    "event_type": EVENT_TYPES, "event_type2": SECOND_EVENT_TYPES, "side": SIDES,
    "shot_place": SHOT_PLACES, "shot_outcome": SHOT_OUTCOMES, "location": LOCATIONS,
    "bodypart": BODY_PARTS, "assist_method": ASSIST_METHODS, "situation": SITUATIONS,
}

STATE_CODES = {
    "ALABAMA": "AL", "ALASKA": "AK", "AMERICAN SAMOA": "AS", "ARIZONA": "AZ",
    "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT",
    "DELAWARE": "DE", "DISTRICT OF COLUMBIA": "DC", "FLORIDA": "FL", "GEORGIA": "GA",
    "GUAM": "GU", "HAWAII": "HI", "HAWAII WATERS": "HI", "IDAHO": "ID", "ILLINOIS": "IL",
    "INDIANA": "IN", "IOWA": "IA", "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA",
    "MAINE": "ME", "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI",
    "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO", "MONTANA": "MT",
    "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH", "NEW JERSEY": "NJ",
    "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND",
    "OHIO": "OH", "OKLAHOMA": "OK", "OREGON": "OR", "PENNSYLVANIA": "PA",
    "PUERTO RICO": "PR", "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC",
    "SOUTH DAKOTA": "SD", "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT",
    "VERMONT": "VT", "VIRGIN ISLANDS": "VI", "VIRGINIA": "VA", "WASHINGTON": "WA",
    "WEST VIRGINIA": "WV", "WISCONSIN": "WI", "WYOMING": "WY",
}

PERMITTED_STORM_EVENTS = (
    "ASTRONOMICAL LOW TIDE", "AVALANCHE", "BLIZZARD", "COASTAL FLOOD", "COLD/WIND CHILL",
    "DEBRIS FLOW", "DENSE FOG", "DENSE SMOKE", "DROUGHT", "DUST DEVIL", "DUST STORM",
    "EXCESSIVE HEAT", "EXTREME COLD/WIND CHILL", "FLASH FLOOD", "FLOOD", "FROST/FREEZE",
    "FUNNEL CLOUD", "FREEZING FOG", "HAIL", "HEAT", "HEAVY RAIN", "HEAVY SNOW", "HIGH SURF",
    "HIGH WIND", "HURRICANE/TYPHOON", "ICE STORM", "LAKE-EFFECT SNOW", "LAKESHORE FLOOD",
    "LIGHTNING", "MARINE HAIL", "MARINE HIGH WIND", "MARINE STRONG WIND",
    "MARINE THUNDERSTORM WIND", "RIP CURRENT", "SEICHE", "SLEET", "STORM SURGE/TIDE",
    "STRONG WIND", "THUNDERSTORM WIND", "TORNADO", "TROPICAL DEPRESSION", "TROPICAL STORM",
    "TSUNAMI", "VOLCANIC ASH", "WATERSPOUT", "WILDFIRE", "WINTER STORM", "WINTER WEATHER",
)
STORM_LABELS = {"THUNDERSTORM WIND": "Thunderstorm Wind.*", "TORNADO": "Tornado.*"}
MAGNITUDE_LETTERS = ("K", "M", "B")

KAFKA_ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

WIKI_EDIT = T.StructType([
    T.StructField("wikipedia", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("page", T.StringType(), False),
    T.StructField("isRobot", T.BooleanType(), False),
])

DISK_ATTRIBUTES = T.StructType([
    T.StructField("availability", T.StringType()),
    T.StructField("ebs_volume_count", T.IntegerType()),
    T.StructField("ebs_volume_type", T.StringType()),
    T.StructField("ebs_volume_size", T.IntegerType()),
])

MATCH_EVENTS = T.StructType([
    T.StructField(name, T.IntegerType() if number else T.StringType())
    for name, number in (
        ("id_odsp", False), ("id_event", False), ("sort_order", True), ("time", True),
        ("text", False), ("event_type", True), ("event_type2", True), ("side", True),
        ("event_team", False), ("opponent", False), ("player", False), ("player2", False),
        ("player_in", False), ("player_out", False), ("shot_place", True),
        ("shot_outcome", True), ("is_goal", True), ("location", True), ("bodypart", True),
        ("assist_method", True), ("situation", True), ("fast_break", True),
    )
])
