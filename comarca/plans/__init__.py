"""Composed tables: staging, rollup, marts, dashboard, quality."""
