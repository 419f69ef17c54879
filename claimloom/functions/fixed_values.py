"""Values that must be exactly these for results to be right.

Procedure and revenue codes that mark an emergency department visit, and the
categories that count as surgery only during an inpatient stay.
"""

# Emergency department procedure codes.
EMERGENCY_HCPCS = (
    "99281",
    "99282",
    "99283",
    "99284",
    "99285",
    "99286",
    "99287",
    "99288",
    "G0380",
    "G0381",
    "G0382",
    "G0383",
    "G0384",
)

# Emergency department revenue codes.
EMERGENCY_REVENUE = ("0450", "0451", "0452", "0456", "0459", "0981")

# Categories that are valid for inpatient stays only.
INPATIENT_ONLY_CATEGORIES = ("ccs152", "ccs153", "ccs158")

# Leading characters of the line case of surgical lines.
INPATIENT_CASE = "I12"
OUTPATIENT_CASE = "O12"
