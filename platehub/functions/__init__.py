"""platehub.functions"""
