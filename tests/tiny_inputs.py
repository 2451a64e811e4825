"""Tiny raw inputs that several test modules share."""

ADS_HEADER = ["id", "click", "hour", "C1", "banner_pos", "site_id", "site_domain", "site_category",
              "app_id", "app_domain", "app_category", "device_id", "device_ip", "device_model",
              "device_type", "device_conn_type", "C14", "C15", "C16", "C17", "C18", "C19", "C20",
              "C21"]


def tiny_ads_rows():
    """Three raw rows: clean; unknown site and device; invalid click and hour."""
    rows = []
    for i, (rid, click, hour, site, dev, banner, scat, acat) in enumerate([
            ("1001", "1", "14102108", "site_a", "1", "0", "cat_a", "appcat_a"),
            ("1002", "0", "14102109", None, "-1", "1", "cat_b", "appcat_b"),
            ("1003", "9", "99999999", "site_c", "0", "2", "cat_c", "appcat_c")]):
        s = "abc"[i]
        rows.append((rid, click, hour, "1005", banner, site, f"dom_{s}", scat, f"app_{s}",
                     f"appdom_{s}", acat, f"dev_{s}", f"ip_{s}", f"model_{s}", dev, "2",
                     str(100 * (i + 1)), "320", "50", str(1000 + i), "0", "35", str(100 + i),
                     str(79 + i)))
    return rows


EXP_HEADER = ["recency", "history_segment", "history", "mens", "womens", "zip_code", "newbie",
              "channel", "segment", "visit", "conversion", "spend"]


def tiny_experiment_rows(dirty: bool = False):
    rows = [
        ("10", "2) $100 - $200", "142.44", "1", "0", "Surburban", "0", "Phone", "Womens E-Mail", "1", "0", "25.0"),
        ("6", "3) $200 - $350", "329.08", "1", "1", "Rural", "1", "Web", "No E-Mail", "0", "0", "0.0"),
        ("7", "2) $100 - $200", "180.65", "0", "1", "Urban", "0", "Web", "Mens E-Mail", "1", "1", "50.0"),
        ("3", "1) $0 - $100", "45.34", "0", "0", "Urban", "1", "Phone", "Mens E-Mail", "0", "0", "10.0"),
    ]
    if dirty:
        rows += [
            ("4", "1) $0 - $100", "45.34", "0", "0", "Urban", "1", "Phone", "Mens E-Mail", "0", "0", "-5.0"),
            ("5", "1) $0 - $100", "45.34", "0", "0", "Urban", "1", "Phone", "No E-Mail", "2", "0", "1.0"),
        ]
    return rows
