"""Hand-made inputs with known answers."""

import datetime
import math

VOLUMES = [
    "ResidueGasVolume", "Energy", "EthaneMixVolume", "EthaneSpecVolume", "PropaneMixVolume", "PropaneSpecVolume",
    "ButaneMixVolume", "ButaneSpecVolume", "PentaneMixVolume", "PentaneSpecVolume", "LiteMixVolume"]


def month(i, year=2020):
    return datetime.date(year + i // 12, i % 12 + 1, 1)


def meta(well):
    return {
        "ReportingFacilityID": f"FAC_{well}", "ReportingFacilityName": f"Facility {well}", "OperatorBAID": f"OP_{well}",
        "OperatorName": "Operator", "WellLicenseNumber": f"LIC_{well}", "Field": f"Field_{well}",
        "Pool": f"Pool_{well}", "Area": f"Area_{well}"}


def declining(wells=("W1", "W2"), months=24):
    """Oil 100 exp(-0.05 i), gas 500 exp(-0.03 i), with a fixed wobble in place of noise."""
    rows = []
    for w in wells:
        for i in range(months):
            oil = 100 * math.exp(-0.05 * i) + 3 * math.sin(1.7 * i)
            gas = 500 * math.exp(-0.03 * i) + 12 * math.sin(2.3 * i)
            rows.append({
                "WellID": w, "ProductionMonth": month(i), "DaysFromFirst": 30 * i, "OilProduction": oil,
                "GasProduction": gas, "CondensateProduction": oil * 0.1, "WaterProduction": oil * 0.2,
                "Hours": 720.0, **meta(w), **{v: 0.0 for v in VOLUMES}})
    return rows


def three_months(hours=730.0):
    data = zip((100.0, 80.0, 60.0), (10.0, 8.0, 6.0), (5.0, 4.0, 3.0), (1.0, 1.0, 1.0))
    return [{"WellID": "W1", "ProductionMonth": month(i, 2024), "Hours": hours, "GasProduction": g, "OilProduction": o,
             "CondensateProduction": c, "WaterProduction": w, **meta("W1")} for i, (g, o, c, w) in enumerate(data)]
