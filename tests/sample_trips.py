"""Rows that several test files build trips from."""

TARGETS = ["01F2930N", "01F2930S", "01F3019N", "01F3019S"]


def raw_row(**fields):
    row = {
        "VehicleType": "31",
        "DetectionTime_O": "2026-03-01 08:00:00",
        "GantryID_O": "01F2930N",
        "DetectionTime_D": "2026-03-01 08:20:00",
        "GantryID_D": "01F3083N",
        "TripLength": "10.5",
        "TripEnd": "Y",
        "TripInformation": "",
    }
    row.update(fields)
    return row
