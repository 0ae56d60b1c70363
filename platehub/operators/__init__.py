"""platehub.operators"""
