"""Runnable jobs: ``python -m mediaspark.jobs.<name> --base <lake folder>``."""
