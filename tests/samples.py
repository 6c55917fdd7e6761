"""Invented records, one of each kind, with only the fields the accounting reads."""

UPSTREAM_PLAYLIST = {
    "user": "17", "unix_time": "1700003200", "svr_type": 1, "http_stat": 200,
    "request_url": "GET /harbor/camera__redirect__58.m3u8 HTTP/1.1", "body_bytes_sent": 412,
    "server_addr": "192.0.2.15", "request_time": "0.004", "remote_addr": "198.51.100.7",
}
SEGMENT = {
    "unix_time": "1700003456", "http_stat": 200, "body_bytes_sent": 90210,
    "request_url": "GET /summit/summit-east-1700003000-5512-77-4000.ts HTTP/1.1",
    "server_addr": "192.0.2.44", "request_time": "0.000",
}
PLAYLIST = {
    "unix_time": "1700003999", "http_stat": 200, "body_bytes_sent": 318,
    "request_url": "GET /valley/valley__redirect_.m3u8 HTTP/1.1",
    "server_addr": "198.51.100.21", "request_time": "0.003",
}
SESSION = {
    "Cmd": "play", "EndTime": 1700010000, "App": "reef", "Stream": "north",
    "SvrIp": "192.0.2.99", "SendByteSum": 271828180, "RecvByteSum": 0,
    "PublishTime": 181000, "PlayTime": 181000, "PlayFluency": 98, "PlayFluencyIn60s": 97,
    "EmptyNumbers": 2, "EmptyTime": 350, "MaxEmptyTime": 200, "FirstBufferTime": 75,
    "EmptyNumbersIn60s": 1, "EmptyTimeIn60s": 120, "Max60sFluency": 99, "Min60sFluency": 97.25,
}
