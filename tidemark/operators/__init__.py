"""The models: staging, intermediate, marts, reports, data checks, extensions."""
