"""Layer builds: Bronze, Silver, Gold and the validated full build."""
