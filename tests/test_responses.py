from scoreflow.operators.responses import normalise_responses


def test_bad_bodies(spark):
    rows = [
        (1, "success", 200, '{"Header":{"ResponseCode":200,"ResponseMessage":"OK","Language":"TH"}}', "20240105"),
        (2, "success", 204, "", "20240105"),
        (3, "error", 500, "{not json", "20240106"),
        (4, "success", 200, '{"Header":{"ResponseCode":200}}', "bad"),
        (5, "error", 404, None, None),
    ]
    df = spark.createDataFrame(rows, "request_id long, status string, status_code int, body string, data_dt string")
    out = {r["request_id"]: r for r in normalise_responses(df).collect()}
    assert out[1]["response_code"] == 200 and out[1]["language"] == "TH" and out[1]["data_date"] == "2024-01-05"
    assert out[2]["response_code"] is None and out[2]["status_class"] == "success"
    assert out[3]["response_code"] is None and out[3]["status_class"] == "error"
    assert out[4]["response_code"] == 200 and out[4]["response_message"] is None and out[4]["data_date"] is None
    assert out[5]["response_code"] is None and out[5]["status_class"] == "error"
