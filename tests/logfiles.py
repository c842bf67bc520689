"""Hand-written log files."""

import json
import os

API_DAY = [
    {"timestamp": "Sun, 12 Jul 2026 00:00:04 AM", "event.action": "posting_job.started", "level": "info", "user.id": 7,
     "request.id": "r1", "service.name": "web", "event.duration_ms": 12.5, "platform.name": "twitter"},
    {"timestamp": "Sun, 12 Jul 2026 18:13:04 PM", "event.action": "posting_job.failed", "level": "error", "user.id": "7",
     "request.id": "r1", "service.name": "web", "error.message": "upstream failed", "error.stack": "Error\n  at f"},
    {"timestamp": "Sun, 12 Jul 2026 12:00:04 AM", "message": "HTTP REQUEST", "level": "info", "service.name": "web"},
    {"timestamp": "Sun, 12 Jul 2026 12:00:05 PM", "message": "Twitter token refresh failed for user 7", "level": "warn",
     "user.id": 7, "service.name": "worker"},
    {"timestamp": "not a time", "message": "The Max FPS found is 60\r\nstack", "level": "error", "user.id": "x"},
]

TRACE = {
    "timestamp": "Tue, 21 Jul 2026, 00:00:47 pm",
    "trace.method": {
        "event.action": "cobrand.job.process",
        "method.name": "run",
        "event.duration_ms": 100,
        "result": {"result.status": "failed"},
        "attributes": {"user.id": 7, "request.id": "from attributes"},
        "details": {"request.id": "r1", "error.message": "in details"},
        "children": [
            {"event.action": "cobrand.pdf.generate", "error": {"message": "plain", "stack": "s"}, "children": [
                {"event.action": "cobrand.s3.upload", "timestamp": "Tue, 21 Jul 2026, 01:00:00 am",
                 "details": {"queue.remaining_count": 4, "callback.completed": True}}]},
            {"event.action": "cobrand.image.generate", "error": {"error.message": "dotted"}, "children": []},
        ],
    },
}

STANDALONE = {"timestamp": "Tue, 21 Jul 2026, 02:00:00 am", "level": "error", "user.id": "7",
              "message": "Scheduled post media is not ready yet", "service.name": "render"}


def write(path, lines):
    """Lines are dictionaries or raw text."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text + "\n")


def standard(folder):
    """One API file and one Cobrand file, each with a malformed line."""
    write(f"{folder}/logs/api/application-2026-07-12.log", [*API_DAY, "", '{"a":1'])
    write(f"{folder}/logs/cobrand/application-2026-07-21.log", [TRACE, STANDALONE, TRACE, '{"a":1} xyz'])
    from logloom.plans.refresh import LogFolders

    return LogFolders(f"{folder}/logs/api/*.log", f"{folder}/logs/cobrand/*.log", f"{folder}/archive")
